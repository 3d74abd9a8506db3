"""Filters and explodes that don't make Spark compute dear columns twice."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_where(rows: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """``rows.where(condition).select(columns)`` for columns that are dear to compute.

    A plain filter is pushed below the projection that computes its columns, so each
    row would be parsed once for the filter and once for the result. ``explode``
    keeps the filter above it.
    """
    kept = F.when(condition, F.array(F.struct(*columns)))
    return rows.select(F.explode(kept).alias("row")).select("row.*")


def rows_of_list(rows: DataFrame, keep: list[str], column: str) -> DataFrame:
    """``keep, pos, item`` of a list column; empty and null lists give no rows.

    The outer form keeps Spark from inferring a filter on the list, which would be
    pushed below the projection that computes the list.
    """
    return rows.select(*keep, F.posexplode_outer(column).alias("pos", "item")).where(
        F.col("pos").isNotNull()
    )
