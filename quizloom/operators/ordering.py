"""Dataset order, and row positions without a single-task window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.staging import ROW, staged


def dataset_order(order: str = "number_first", missing_edition=0) -> list[Column]:
    """Sort columns of the combined dataset.

    The exported file is ordered by number, then edition (``number_first``); the
    id makes ties fixed and lets Spark split a number that many rows share.
    """
    edition = F.coalesce(F.col("edition"), F.lit(missing_edition))
    number = F.col("question_number")
    if order == "number_first":
        return [number, edition, F.col("id")]
    if order == "edition_first":
        return [edition, number, F.col("id")]
    raise ValueError(f"unknown order {order!r}")


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Number all rows from 1 in a global order.

    A window over the whole table would sort it in one task. Instead the range
    sort is written once, each row with its partition and its place there; the
    offsets come from one count per partition.
    """
    # Rows equal in all sort columns are told apart, so that they need not share a task.
    apart = df.withColumn(ROW, F.monotonically_increasing_id()).orderBy(*order, ROW).drop(ROW)
    rows = staged(apart.withColumn("_place", F.monotonically_increasing_id()), "sorted")
    partition = F.shiftright("_place", 33)
    # One row per sort partition: small by construction.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    in_partition = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + in_partition + 1)
        .drop("_partition", "_offset", "_place")
    )
