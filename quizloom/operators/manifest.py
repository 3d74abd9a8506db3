"""Download manifests: upsert, what is missing, completeness."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import MIN_DOCUMENT_BYTES


def large_enough(documents: DataFrame, min_bytes: int = MIN_DOCUMENT_BYTES) -> DataFrame:
    """Documents of a plausible size (``length`` in bytes)."""
    return documents.where(F.col("length") >= min_bytes)


def upsert_keys(
    base: DataFrame, updates: DataFrame, min_bytes: int = MIN_DOCUMENT_BYTES
) -> DataFrame:
    """Replace answer-key URLs by those of valid updates, edition by edition.

    ``updates`` has ``edition, ord, gabarito_url, length``; the last valid one of an
    edition counts, and one for an edition not in ``base`` is added.
    """
    valid = (
        large_enough(updates, min_bytes)
        .groupBy("edition")
        .agg(F.max_by("gabarito_url", "ord").alias("new_url"))
    )
    return base.join(valid, "edition", "full_outer").select(
        "edition", "prova_url", F.coalesce("new_url", "gabarito_url").alias("gabarito_url")
    )


def not_yet_present(targets: DataFrame, present: DataFrame, key: str = "file_name") -> DataFrame:
    return targets.join(present, key, "left_anti")


def completeness(records: DataFrame) -> DataFrame:
    """Add ``missing`` (names of absent documents) and ``status`` OK or PARTIAL."""
    missing = F.array_compact(
        F.array(
            F.when(F.coalesce("prova_url", F.lit("")) == "", F.lit("prova")),
            F.when(F.coalesce("gabarito_url", F.lit("")) == "", F.lit("gabarito")),
        )
    )
    return records.withColumn("missing", missing).withColumn(
        "status", F.when(F.size("missing") == 0, "OK").otherwise("PARTIAL")
    )


def status_totals(checked: DataFrame) -> DataFrame:
    return checked.groupBy("status").agg(F.count(F.lit(1)).alias("editions"))
