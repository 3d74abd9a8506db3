"""Parse tagged raw text into dataset rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import NUMBERED_SERIES
from quizloom.functions import names, text
from quizloom.functions.rows import rows_where
from quizloom.operators.enrich import normalized_area


def blocks_of_texts(texts: DataFrame) -> DataFrame:
    """``stem, value`` rows, one per file, as ``stem, block_no, block`` rows."""
    return texts.select(
        "stem",
        F.posexplode(text.blocks(text.unix_lines(F.col("value")))).alias("block_no", "block"),
    )


def parse_blocks(blocks: DataFrame, series: str = NUMBERED_SERIES) -> DataFrame:
    """Parse each block; ``reason`` is null on a good one and says what is wrong else."""
    block = F.col("block")
    sides = blocks.withColumn("block", text.strip(block)).withColumns(
        {"_sides": text.options_split(block), "_head": text.header(block)}
    )
    before, options = (F.get("_sides", F.lit(i)) for i in (0, 1))
    parsed = sides.withColumns(
        {
            "question_number": text.header_number(F.col("_head")),
            "nullified": text.header_is_null(F.col("_head")),
            "statement": text.statement(before, block),
            "has_options": options.isNotNull(),
            "_alts": text.alternatives(options),
            "_tag": text.area_tag(block),
            "year": names.stem_year(F.col("stem")),
            "edition": names.stem_edition(F.col("stem")),
            "source_format": F.lit("raw_text"),
        }
    )
    reason = (
        F.when(block == "", "empty block")
        .when(F.col("question_number").isNull(), "bad header")
        .when(~F.col("has_options"), "no options")
        .when(F.col("statement") == "", "empty statement")
        .when(F.col("year").isNull() | F.col("edition").isNull(), "bad file name")
    )
    source = F.concat(F.lit(f"{series}-"), F.col("edition").cast("string"))
    return parsed.withColumns(
        {
            "reason": reason,
            "exam_source": source,
            "id": names.question_id(source, F.col("question_number")),
            "area": normalized_area(F.col("_tag")),
            "alternatives": text.plain_alternatives(F.col("_alts")),
            "correct_answer": F.when(~F.col("nullified"), text.tagged_letter(F.col("_alts"))),
        }
    ).drop("_sides", "_head", "_alts", "_tag")


def good_questions(parsed: DataFrame) -> DataFrame:
    columns = [c for c in parsed.columns if c not in ("reason", "block", "has_options")]
    return rows_where(parsed, F.col("reason").isNull(), columns)


def rejected_blocks(parsed: DataFrame) -> DataFrame:
    """Blocks that gave no question. Text before the first header is one of them."""
    columns = [c for c in ("stem", "file_path", "split_start", "block_no") if c in parsed.columns]
    return rows_where(parsed, F.col("reason").isNotNull(), [*columns, "block", "reason"])
