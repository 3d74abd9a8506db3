"""Run and dataset reports. Lists come as ordered rows, so no group is collected."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import EXAM_KIND, KEY_KIND, KEY_PAGE_PREFIX


def failed_pages(pages: DataFrame) -> DataFrame:
    """``exam, kind_rank, page, label``: exam pages first, key pages as ``gab-N``.

    Ordering by the first three columns gives the reported order.
    """
    is_key = F.col("doc_kind") == KEY_KIND
    label = F.col("page").cast("string")
    return pages.where("failed").select(
        "exam",
        F.when(is_key, 1).otherwise(0).alias("kind_rank"),
        "page",
        F.when(is_key, F.concat(F.lit(KEY_PAGE_PREFIX), label)).otherwise(label).alias("label"),
    )


def page_totals(pages: DataFrame) -> DataFrame:
    """Pages by kind, failed pages and questions found, per exam.

    ``found`` is the number of questions or answers on the page.
    """
    exam_page = F.col("doc_kind") == EXAM_KIND
    return pages.groupBy("exam").agg(
        F.count_if(exam_page).alias("exam_pages"),
        F.count_if(F.col("doc_kind") == KEY_KIND).alias("key_pages"),
        F.count_if("failed").alias("failed_pages"),
        F.sum(F.when(exam_page, F.col("found")).otherwise(0)).alias("questions_found"),
    )


def dataset_summary(rows: DataFrame, text_branch: str = "text") -> DataFrame:
    """Rows in all and per branch, distinct editions and their bounds (0 if none).

    Counts go by edition first: the global step sees one row per edition.
    """
    by_edition = rows.groupBy("edition").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("branch") == text_branch).alias("n_text")
    )
    total, from_text = F.sum("n"), F.sum("n_text")
    return by_edition.agg(
        F.coalesce(total, F.lit(0)).alias("questions"),
        F.coalesce(from_text, F.lit(0)).alias("text_questions"),
        F.coalesce(total - from_text, F.lit(0)).alias("page_questions"),
        F.count("edition").alias("editions"),
        F.coalesce(F.min("edition"), F.lit(0)).alias("first_edition"),
        F.coalesce(F.max("edition"), F.lit(0)).alias("last_edition"),
    )


def per_exam_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("exam_source").agg(
        F.count(F.lit(1)).alias("questions"), F.count_if("nullified").alias("nullified")
    )


def run_status(pairs: DataFrame, done: DataFrame, errors: DataFrame) -> DataFrame:
    """``exam, status, error``: skipped if done before, failed if it has an error.

    ``done`` has the exams skipped (``exam``), ``errors`` at most one row per exam
    (``exam, error``).
    """
    skipped = done.select("exam").distinct().withColumn("was_done", F.lit(True))
    status = (
        F.when(F.col("was_done"), "skipped")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("successful")
    )
    return (
        pairs.select("exam")
        .join(skipped, "exam", "left")
        .join(errors, "exam", "left")
        .select("exam", status.alias("status"), F.when(status == "failed", F.col("error")).alias("error"))
    )


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("exams"))
