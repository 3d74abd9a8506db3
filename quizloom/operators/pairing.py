"""Pair exam documents with their answer keys by file name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import EXAM_SUFFIX, KEY_SUFFIX
from quizloom.functions.names import file_stem, without_suffix


def documents_by_base(
    listing: DataFrame, exam_suffix: str = EXAM_SUFFIX, key_suffix: str = KEY_SUFFIX
) -> DataFrame:
    """``folder, exam_name, exam_path, key_path``, one row per base name.

    One scan and one partially aggregated shuffle give both the pairs and the
    exams without a key. A name may end in both suffixes, hence two roles.
    """
    stem = file_stem(F.col("path"))

    def role(suffix: str, kind: str):
        return F.when(
            F.endswith(stem, F.lit(suffix)),
            F.struct(F.lit(kind).alias("kind"), without_suffix(stem, suffix).alias("exam_name")),
        )

    roles = F.array_compact(F.array(role(exam_suffix, "exam"), role(key_suffix, "key")))
    return (
        listing.where(F.endswith("path", F.lit(".pdf")))
        .select("path", F.explode(roles).alias("role"))
        .groupBy(
            F.regexp_extract("path", r"(?s)\A(.*)/", 1).alias("folder"),
            F.col("role.exam_name").alias("exam_name"),
        )
        .agg(
            F.max(F.when(F.col("role.kind") == "exam", F.col("path"))).alias("exam_path"),
            F.max(F.when(F.col("role.kind") == "key", F.col("path"))).alias("key_path"),
        )
    )


def pairs(documents: DataFrame) -> DataFrame:
    both = F.col("exam_path").isNotNull() & F.col("key_path").isNotNull()
    return documents.where(both).select("exam_name", "exam_path", "key_path")


def unpaired_exams(documents: DataFrame) -> DataFrame:
    """Exams to report and skip. Keys without an exam are of no interest."""
    alone = F.col("exam_path").isNotNull() & F.col("key_path").isNull()
    return documents.where(alone).select("exam_name", "exam_path")
