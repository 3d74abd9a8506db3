"""Page images as inference requests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE_MIME = "image/png"


def base64_text(content: Column) -> Column:
    """Standard base64 without the line breaks that Spark puts in."""
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")


def request_table(pages: DataFrame, prompts: dict[str, str]) -> DataFrame:
    """One request per page: prompt of its kind, base64 image, MIME type.

    Pages of a kind without a prompt have a null one.
    """
    prompt = F.element_at(
        F.create_map(*[F.lit(x) for kv in prompts.items() for x in kv]), F.col("doc_kind")
    )
    return pages.select(
        "exam",
        "doc_kind",
        "page",
        prompt.alias("prompt"),
        base64_text(F.col("content")).alias("data"),
        F.lit(IMAGE_MIME).alias("mime_type"),
    )
