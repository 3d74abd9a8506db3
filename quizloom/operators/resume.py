"""Skip what is done: whole exams, and single pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.payload import page_error
from quizloom.operators import hashed
from quizloom.schemas import ARRIVED_PAGE, PAGE_KEYS
from quizloom.staging import scratch, staged
from quizloom.versions import forget, newest, publish


def finished_exams(outputs: DataFrame, fmt: str) -> DataFrame:
    """Exams whose output (``exam, fmt`` rows) is complete in the asked format."""
    if fmt not in ("jsonl", "csv", "both"):
        raise ValueError(f"unknown format {fmt!r}")
    if fmt != "both":
        return outputs.where(F.col("fmt") == fmt).select("exam").distinct()
    return (
        outputs.groupBy("exam")
        .agg(
            F.bool_or(F.col("fmt") == "jsonl").alias("has_jsonl"),
            F.bool_or(F.col("fmt") == "csv").alias("has_csv"),
        )
        .where("has_jsonl and has_csv")
        .select("exam")
    )


def pending_exams(
    pairs: DataFrame, outputs: DataFrame, fmt: str, force: bool = False
) -> DataFrame:
    if force:
        return pairs
    return pairs.join(finished_exams(outputs, fmt), "exam", "left_anti")


def with_cached_payload(pages: DataFrame, page_table: DataFrame) -> DataFrame:
    """Add ``payload`` and ``from_cache`` in one join of both tables.

    Pages without a hit are the ones to process. The page table has one row per key:
    ``append_new_pages`` sees to that, so no payload is grouped or sorted here.
    """
    cached = page_table.select(*PAGE_KEYS, "payload")
    return pages.join(cached, PAGE_KEYS, "left").withColumn(
        "from_cache", F.col("payload").isNotNull()
    )


def page_state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest version of the page table at ``path`` and its state; 0 before the first append."""
    version, state = newest(spark, path)
    return version, state or hashed.empty()


def read_page_table(
    spark: SparkSession, path: str, buckets: list[int] | None = None, after: int = 0
) -> DataFrame:
    """The page table at ``path``, each key once; some of its buckets, or what arrived after a version.

    Holds to the version that is newest now. ``arrived`` is the version that brought a row;
    parts that hold no later one are not read.
    """
    _, state = page_state(spark, path)
    rows = hashed.read(spark, state, path, ARRIVED_PAGE, buckets, after).drop("part")
    return rows.where(F.col("arrived") > after) if after else rows


def judged_pages(fresh: DataFrame) -> DataFrame:
    """Adds ``reason``: why an arrived row can't be stored; null for good and for failed pages.

    A ``_corrupt_record`` column, if there is one, holds lines that could not be read.
    A row without a flag hasn't failed.
    """
    failed = F.coalesce("failed", F.lit(False))
    missing = F.lit(False)
    for name in PAGE_KEYS:
        missing = missing | F.col(name).isNull()
    reason = F.when(missing, "missing key").when(~failed, page_error(fresh))
    if "_corrupt_record" in fresh.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), "malformed line").otherwise(reason)
    return fresh.withColumns({"failed": failed, "reason": reason})


def append_new_pages(
    fresh: DataFrame,
    path: str,
    quarantine: str | None = None,
    batch: int | str = 0,
    rows_per_bucket: int = hashed.ROWS_PER_BUCKET,
    most_parts: int = hashed.MOST_PARTS,
) -> None:
    """Add the good pages that the table at ``path`` doesn't hold yet; set aside what can't be stored.

    Only pages that decode are stored, so a later good page takes the place of a bad one.
    Rows with a reason go to ``<quarantine>/batch=<batch>`` as they came, with it; failed
    pages go nowhere. Running it again with the same rows and batch changes nothing.

    The table is divided by a linear hash of the exam: it grows by splitting one bucket after
    another, and a bucket's parts are brought together when there are many. Of the buckets
    that the rows belong to, keys are read only where a filter says that one may be known. A
    new version is published when its rows are there, so readers see each key once throughout.
    """
    spark = fresh.sparkSession
    exam = F.col("exam")
    with scratch(spark):
        judged = staged(judged_pages(fresh), "arrived")
        good = judged.where("reason IS NULL AND NOT failed").groupBy(*PAGE_KEYS).agg(F.min("payload").alias("payload"))
        version, state = page_state(spark, path)
        if not state["buckets"]:
            # An empty table starts with buckets enough.
            state = hashed.with_buckets(state, -(-good.count() // rows_per_bucket))
        good = good.withColumn("bucket", hashed.bucket_of(state, exam))
        new = good
        keys = judged.where("reason IS NULL AND NOT failed").select(*PAGE_KEYS)
        held = hashed.maybe_known(spark, state, path, keys.withColumn("bucket", hashed.bucket_of(state, exam)), PAGE_KEYS)
        if held:
            known = hashed.read(spark, hashed.of_parts(state, held), path, ARRIVED_PAGE)
            new = good.join(known.select(*PAGE_KEYS, "bucket"), [*PAGE_KEYS, "bucket"], "left_anti")
        rows = new.withColumn("arrived", F.lit(version + 1).cast("long"))
        counts, slots = hashed.write_part(rows, path, version + 1, PAGE_KEYS)
        if counts:
            state = hashed.added(state, counts, version + 1, slots)
            publish(spark, path, version + 1, state)
            arranged = hashed.arranged(
                spark, state, path, ARRIVED_PAGE, "exam", version + 2, PAGE_KEYS, rows_per_bucket, most_parts
            )
            if arranged != state:
                publish(spark, path, version + 2, arranged)
        bad = judged.where("reason IS NOT NULL")
        if quarantine is not None:
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch}")


def drop_old_pages(spark: SparkSession, path: str) -> None:
    """Delete what the newest version of the page table doesn't hold. No reader may be at work on an older one."""
    version, state = page_state(spark, path)
    forget(spark, path, version)
    hashed.drop_unnamed(spark, state, path)
