from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    """Register the decorated function, under its own name by default, with its SQL."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines_as_alternatives(text: str = "text"):
    """Lines of a text as ``array<struct<letra, texto>>``, lettered A to Z in turn."""
    return F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(
            F.char(F.lit(65) + F.pmod(i, F.lit(26))).alias("letra"), line.alias("texto")
        ),
    )


def joined(alternatives, letter: str, text: str):
    """``A:text|B:text`` for comparing nested values."""
    return F.array_join(
        F.transform(alternatives, lambda a: F.concat(a[letter], F.lit(":"), a[text])), "|"
    )


# The same in SQL, for a list column ``alts`` of lines.
JOINED_SQL = (
    "array_to_string(list_transform(alts, lambda x, i: chr((65 + (i - 1) % 26)::int) || ':' || x), '|')"
)
