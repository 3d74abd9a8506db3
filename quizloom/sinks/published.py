"""Datasets that stay readable while they are written anew.

An export goes to a folder of its own number, an index of its part files beside it, and then
one small file names it (``quizloom.versions``). Readers follow that file, so they see the
whole old dataset or the whole new one; a job that dies on the way changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.schemas import EXAM_QUESTION
from quizloom.sinks.export import CSV_READ, PACKED, export, export_per_exam, formats
from quizloom.sources.files import question_dataset
from quizloom.staging import removed
from quizloom.versions import forget, newest, publish, state_of, subfolders, versions

#: A row for each part file: what it holds lies between the firsts and the lasts.
INDEX = "file string, first_number bigint, last_number bigint, first_exam string, last_exam string, rows bigint"


def _text_columns(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Exam and number of each row of an exported dataset, as the files have them."""
    if fmt == "csv":
        return spark.read.options(**CSV_READ).csv(path)
    return spark.read.schema("exam_source string, question_number bigint").json(path)


def part_index(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``INDEX`` rows of an exported dataset, by one aggregate over two columns of it."""
    number, exam = F.col("question_number").cast("bigint"), F.col("exam_source")
    return _text_columns(spark, path, fmt).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
        F.min(exam).alias("first_exam"),
        F.max(exam).alias("last_exam"),
        F.count(F.lit(1)).alias("rows"),
    )


def publish_dataset(
    rows: DataFrame, root: str, fmt: str = "jsonl", order: list[Column] | None = None, per_exam: bool = False
) -> int:
    """Write ``rows`` as the next version of the dataset at ``root``; returns its number.

    Sorted by ``order``, by default number and id, as ``export`` does, and by exam with
    ``per_exam``. Older versions stay until ``drop_old_versions``, so parts are gzip files.
    """
    spark = rows.sparkSession
    version = newest(spark, root)[0] + 1
    folder = f"{root.rstrip('/')}/data/v={version}"
    # A job that died may have left a part of this number.
    removed(spark, folder)
    export(rows, f"{folder}/all", fmt, order, **PACKED)
    for one in formats(fmt):
        index = part_index(spark, f"{folder}/all.{one}", one)
        index.coalesce(1).sortWithinPartitions("file").write.parquet(f"{folder}/index-{one}")
    if per_exam:
        export_per_exam(rows, folder, fmt, **PACKED)
    publish(spark, root, version, {"folder": f"data/v={version}", "formats": formats(fmt), "per_exam": per_exam})
    return version


def published_files(
    spark: SparkSession,
    root: str,
    fmt: str = "jsonl",
    numbers: tuple[int, int] | None = None,
    exam: str | None = None,
    version: int | None = None,
) -> list[str]:
    """The part files of a version, the newest by default, that may hold a range of numbers or an exam."""
    number, state = newest(spark, root)
    if version is not None and version != number:
        number, state = version, state_of(spark, root, version)
    if not number:
        raise FileNotFoundError(f"nothing is published at {root}")
    if fmt not in state["formats"]:
        raise ValueError(f"version {number} was not written as {fmt!r}")
    folder = f"{root.rstrip('/')}/{state['folder']}"
    index = spark.read.schema(INDEX).parquet(f"{folder}/index-{fmt}")
    if numbers is not None:
        index = index.where((F.col("last_number") >= numbers[0]) & (F.col("first_number") <= numbers[1]))
    if exam is not None:
        index = index.where((F.col("last_exam") >= exam) & (F.col("first_exam") <= exam))
    return [f"{folder}/all.{fmt}/{r['file']}" for r in index.select("file").orderBy("file").collect()]


def read_published(
    spark: SparkSession,
    root: str,
    numbers: tuple[int, int] | None = None,
    exam: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Rows of a published JSONL dataset, of a range of numbers (both ends included) or an exam if given.

    Only the parts that may hold them are opened.
    """
    files = published_files(spark, root, "jsonl", numbers, exam, version)
    if not files:
        return spark.createDataFrame([], EXAM_QUESTION)
    rows = question_dataset(spark, files)
    if numbers is not None:
        rows = rows.where(F.col("question_number").between(*numbers))
    return rows if exam is None else rows.where(F.col("exam_source") == exam)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete all versions but the newest ``keep`` and what no version names. No reader may be at work on them."""
    kept = versions(spark, root)[-max(1, keep) :]
    if not kept:
        return
    forget(spark, root, kept[0])
    for folder in subfolders(spark, f"{root.rstrip('/')}/data"):
        if int(folder.removeprefix("v=")) not in kept:
            removed(spark, f"{root.rstrip('/')}/data/{folder}")
