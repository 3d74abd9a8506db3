"""Column functions for ids, file names and editions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.fixed_values import DATED_SERIES, NUMBERED_SERIES


def question_id(source: Column, number: Column) -> Column:
    """``source-007``: padded to three digits, never cut."""
    return F.format_string("%s-%03d", source, number)


def file_stem(path: Column) -> Column:
    """Last path part without its extension."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")


def without_suffix(text: Column, suffix: str) -> Column:
    """``text`` without a literal ``suffix``; unchanged when it doesn't end in it."""
    return F.when(
        F.endswith(text, F.lit(suffix)),
        F.left(text, F.length(text) - F.lit(len(suffix))),
    ).otherwise(text)


def numbered_edition(name: Column, series: str = NUMBERED_SERIES) -> Column:
    """Edition number after ``<series>-`` anywhere in the name; null without a match."""
    return F.regexp_extract(name, rf"{re.escape(series)}-(\d+)", 1).try_cast("int")


def dated_edition(name: Column, series: str = DATED_SERIES) -> Column:
    """``struct<edition, year, semester, reapplication>``; null without a match."""
    pattern = rf"{re.escape(series)}-(\d{{4}})(\d)(r?)"
    year, semester, again = (F.regexp_extract(name, pattern, i) for i in (1, 2, 3))
    return F.when(
        year != "",
        F.struct(
            F.concat(year, semester, again).alias("edition"),
            year.cast("int").alias("year"),
            semester.cast("int").alias("semester"),
            (again != "").alias("reapplication"),
        ),
    )


def stem_year(stem: Column) -> Column:
    return F.get(F.split(stem, "-"), F.lit(0)).try_cast("int")


def stem_edition(stem: Column) -> Column:
    """Edition of a ``2012-06a`` stem: the second part without trailing ``a``."""
    part = F.get(F.split(stem, "-"), F.lit(1))
    return F.regexp_replace(part, r"a+\z", "").try_cast("int")
