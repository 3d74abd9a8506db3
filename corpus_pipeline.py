"""Cleans the documents table in stages, each written as Parquet and read again.

Every stage takes the documents that its predecessor kept and returns those that it
keeps, with the columns of documents; the last one returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm.common import in_fold, table
from quizloom.llm.decontamination import clean_documents
from quizloom.llm.language_id import UNKNOWN, is_foreign, learn_trees, predict_language, usual_bits
from quizloom.llm.line_dedup import dedup_lines
from quizloom.llm.piece_tokenizer import encode_texts
from quizloom.llm.simhash_trie import one_of_each
from quizloom.staging import staged

#: A language is taken if it is likelier than all others together.
LEAST_SURE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learned languages; ``lang`` becomes the predicted one.

    Texts that are null, empty or without a letter go, those of uncertain language, and those that
    no learned language codes nearly as short as its own training texts (foreign ones, gibberish).
    """
    learn = ~in_fold(F.col("doc_id"), 5)
    trees = learn_trees(docs, learn=learn)
    usual = usual_bits(predict_language(docs.where(learn & F.col("lang").isNotNull()).select("text"), trees))
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SURE) & ~is_foreign(usual)
    kept = predict_language(docs, trees).where(known)
    return kept.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; those of which no word is left go."""
    rewritten = dedup_lines(docs)
    left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = rewritten.where(left)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, words=4, most_bits=4).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    return encode_texts(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: No stage but the last could be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
