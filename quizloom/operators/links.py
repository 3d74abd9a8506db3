"""Exam and answer-key links of stored web pages, without leaving the row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom import fixed_values as fixed
from quizloom.functions import html
from quizloom.functions.rows import rows_of_list


def with_links(pages: DataFrame, needle: str = ".pdf") -> DataFrame:
    """Add ``links``: ``array<struct<text, href, url>>`` in page order."""
    root = html.site_root(F.col("url"))
    found = pages.withColumn("_found", html.links(F.col("html"), needle))
    resolved = F.transform(
        "_found",
        lambda a: F.struct(
            a["text"].alias("text"),
            a["href"].alias("href"),
            html.resolve_url(a["href"], root).alias("url"),
        ),
    )
    return found.withColumn("links", resolved).drop("_found")


def link_rows(pages: DataFrame) -> DataFrame:
    """``page_id, pos, text, href, url``, one row per link."""
    return rows_of_list(pages, ["page_id"], "links").select("page_id", "pos", "item.*")


def _has_all(text: Column, words: list[str]) -> Column:
    result = F.lit(True)
    for word in words:
        result = result & F.contains(text, F.lit(word))
    return result


def _has_none(text: Column, words: list[str]) -> Column:
    result = F.lit(True)
    for word in words:
        result = result & ~F.contains(text, F.lit(word))
    return result


def classify_links(
    pages: DataFrame,
    exam_text: str = fixed.EXAM_LINK_TEXT,
    exam_href: str = fixed.EXAM_LINK_HREF,
    key_all: list[str] = fixed.KEY_LINK_ALL,
    key_none: list[str] = fixed.KEY_LINK_NONE,
    fallback_all: list[str] = fixed.FALLBACK_KEY_ALL,
    fallback_none: list[str] = fixed.FALLBACK_KEY_NONE,
) -> DataFrame:
    """Per page the first exam link, the first key link, and how many links it has.

    The key falls back to a wider rule only if no link meets the narrow one.
    """

    def first_url(rule) -> Column:
        return F.get(F.filter("links", rule), F.lit(0))["url"]

    def is_exam(a: Column) -> Column:
        return F.contains(F.lower(a["text"]), F.lit(exam_text)) | F.contains(
            F.lower(a["href"]), F.lit(exam_href)
        )

    def is_key(a: Column) -> Column:
        text = F.lower(a["text"])
        return _has_all(text, key_all) & _has_none(text, key_none)

    def is_fallback(a: Column) -> Column:
        text = F.lower(a["text"])
        return _has_all(text, fallback_all) & _has_none(text, fallback_none)

    return pages.select(
        "page_id",
        first_url(is_exam).alias("prova_url"),
        F.coalesce(first_url(is_key), first_url(is_fallback)).alias("gabarito_url"),
        F.size("links").alias("total_links"),
    )
