"""Edition, subject and area metadata."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import (
    AREA_FIXES,
    DATED_SERIES,
    NUMBERED_SERIES,
    SUBJECT_AREAS,
    UNKNOWN_AREA,
)
from quizloom.functions.names import dated_edition, numbered_edition
from quizloom.functions.text import strip


def normalized_area(
    area: Column, areas: list[str] = SUBJECT_AREAS, fixes: dict[str, str] = AREA_FIXES
) -> Column:
    """Known area after fixing misspellings; anything else is "not identified"."""
    clean = strip(area)
    fixed = clean
    for wrong, right in fixes.items():
        fixed = F.when(clean == wrong, right).otherwise(fixed)
    return F.when(fixed.isin(*areas), fixed).otherwise(F.lit(UNKNOWN_AREA))


def fill_numbered_edition(
    rows: DataFrame, name: str = "exam_name", series: str = NUMBERED_SERIES
) -> DataFrame:
    """Set ``edition`` and ``source_format`` from the exam name where no edition is set.

    ``rows`` has both columns, the edition as INT.
    """
    found = numbered_edition(F.col(name), series)
    fill = F.col("edition").isNull() & found.isNotNull()
    return rows.withColumns(
        {
            "edition": F.when(fill, found).otherwise(F.col("edition")),
            "source_format": F.when(fill, F.lit("pdf")).otherwise(F.col("source_format")),
        }
    )


def set_dated_edition(
    rows: DataFrame, name: str = "exam_name", series: str = DATED_SERIES
) -> DataFrame:
    """Overwrite edition, year, semester and reapplication from the exam name.

    A name without a match leaves the row as it was; absent columns become null.
    """
    found = dated_edition(F.col(name), series)
    values = {k: found[k] for k in ("edition", "year", "semester", "reapplication")}
    values["source_format"] = F.when(found.isNotNull(), F.lit("pdf"))
    return rows.withColumns(
        {
            key: F.coalesce(value, F.col(key)) if key in rows.columns else value
            for key, value in values.items()
        }
    )


#: Blocks of 1, 2, 4 ... numbers, up to 2^62; numbers beyond it, or below -2^62, are in no range.
LEVELS = 63


def _blocks(ranges: DataFrame) -> DataFrame:
    """``edition, entry, level, block``: the fewest blocks of 2^level numbers that make up each range.

    At each level at most the first and the last block are left over, those that don't pair up
    to a block of the next one. An empty range has none, and no block is wider than its range.
    """
    most = F.lit(1 << (LEVELS - 1))
    known = ranges.where("start_q IS NOT NULL AND end_q IS NOT NULL").select(
        "edition",
        F.struct("ord", "start_q", "end_q", "label").alias("entry"),
        F.greatest("start_q", -most).alias("start"),
        F.least("end_q", most).alias("end"),
    )
    # Half the width: that of the widest ranges is no BIGINT.
    half = F.greatest(F.shiftright("end", 1) - F.shiftright("start", 1), F.lit(0).cast("long")) + 1
    top = F.least(F.length(F.bin(half)), F.lit(LEVELS - 1))
    levels = known.select("*", F.explode(F.sequence(F.lit(0), top)).alias("level"))
    within = _bit(F.col("level")) - 1
    # The first block that starts in the range, and the one behind the last that ends in it.
    levels = levels.withColumns(
        {
            "first": _block(F.col("start")) + (F.col("start").bitwiseAND(within) != 0).cast("long"),
            "stop": _block(F.col("end")) + (F.col("end").bitwiseAND(within) == within).cast("long"),
        }
    )
    odd = lambda x: x.bitwiseAND(F.lit(1)) == 1
    left_over = F.array(F.when(odd(F.col("first")), F.col("first")), F.when(odd(F.col("stop")), F.col("stop") - 1))
    blocks = levels.where("first < stop").select("edition", "entry", "level", F.explode(left_over).alias("block"))
    return blocks.where("block IS NOT NULL")


def _bit(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)


def _block(number: Column) -> Column:
    """The block of the row's ``level`` that holds a number."""
    return F.call_function("shiftright", number.cast("long"), F.col("level"))


def range_blocks(ranges: DataFrame) -> DataFrame:
    """``edition, level, block, first``: the first range in list order that holds all of a block.

    A range becomes at most two blocks a level, a row each, so no cell and no group grows with
    an edition's ranges.
    """
    return _blocks(ranges).groupBy("edition", "level", "block").agg(F.min("entry").alias("first"))


def used_levels(ranges: DataFrame) -> DataFrame:
    """One row with ``levels``: bit i is set if some range has a block of level i."""
    none = F.lit(0).cast("long")
    return _blocks(ranges).agg(F.coalesce(F.bit_or(_bit(F.col("level"))), none).alias("levels"))


def range_labels(points: DataFrame, ranges: DataFrame) -> DataFrame:
    """``edition, number, hit``: the label of the first range that holds each of the distinct ``points``.

    A number lies in one block of each level, and every range that holds it has one of them.
    Asked are the levels of which some range has a block. Both sides are shuffled: Spark takes
    the points for as small as their table, although each comes once a level, and would
    send them all through the driver.
    """
    used = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda x: _bit(x).bitwiseAND(F.col("levels")) != 0)
    # One row.
    levels = used_levels(ranges).select(used).scalar()
    asked = points.select("edition", "number", F.explode(levels).alias("level"))
    asked = asked.withColumn("block", _block(F.col("number")))
    found = asked.hint("merge").join(range_blocks(ranges), ["edition", "level", "block"])
    first = found.groupBy("edition", "number").agg(F.min("first").alias("first"))
    return first.select("edition", "number", F.nullif("first.label", F.lit("")).alias("hit"))


def label_by_range(
    rows: DataFrame,
    ranges: DataFrame,
    label: str = "area",
    edition: str = "edition",
    number: str = "question_number",
) -> DataFrame:
    """Label from the first range of the edition that holds the question number.

    The distinct (edition, number) are looked up, by joins on equal blocks, and each row meets
    its own one: no row of ``rows`` is ever multiplied, and an edition may have any number of
    ranges. Of ``rows`` the lookup reads these two columns. Without a hit, or with edition 0 or
    empty, a label already there stays.
    """
    usable = ~F.col(edition).cast("string").isin("", "0")
    points = rows.where(usable).select(F.col(edition).alias("edition"), F.col(number).alias("number")).distinct()
    hits = range_labels(points, ranges).select(
        F.col("edition").alias("_edition"), F.col("number").alias("_number"), F.col("hit").alias("_hit")
    )
    same = usable & (F.col(edition) == F.col("_edition")) & (F.col(number) == F.col("_number"))
    joined = rows.join(hits, same, "left")
    kept = F.coalesce(F.col("_hit"), F.col(label)) if label in rows.columns else F.col("_hit")
    return joined.withColumn(label, kept).drop("_edition", "_number", "_hit")


def pack_metadata(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Fold typed columns into one VARIANT ``metadata``; null values leave no key."""
    packed = F.parse_json(F.to_json(F.struct(*keys)))
    return rows.withColumn("metadata", packed).drop(*keys)
