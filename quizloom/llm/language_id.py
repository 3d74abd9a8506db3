"""Language by prediction by partial matching: the language whose frozen byte-context tree codes a text shortest.

The trees learn from a bounded sample of the labelled rows, about ``SAMPLE`` bytes for
each language, so a tree has at most that many grams and all of them can be sent to
every task. Long texts are sampled by the block, so one of them neither fills the sample
nor keeps its language out of it. The languages are the distinct labels: a closed set, a few hundred at most.
Prediction is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, packed, packed_sorted, pieces, starts_of, unpacked, unpacked_sorted
from quizloom.llm.ppm import END, Places, Trie, byte_pairs, counted, gram_keys, merged

ORDER = 3
#: Bytes of text to learn from, for each language.
SAMPLE = 4 * MB
#: Longer texts are cut into blocks of so many bytes, each in the sample or not.
BLOCK = MB // 16
CHUNK = 2 * MB
UNKNOWN = "und"
TREE = ["lang", "grams", "counts"]
#: A text is foreign to a language if its code takes so many spreads more bits a byte than the language's own
#: texts on average, and more for short texts: so many bits over the root of the bytes.
FAR, SHORT = 20, 12
LEAST_SPREAD = 0.1

#: Lower case for A-Z; what is no letter of a text's UTF-8 bytes is a blank.
BLANK = 32


def letter_table() -> np.ndarray:
    table = np.full(256, BLANK, np.uint8)
    for c in range(256):
        if ord("a") <= c <= ord("z") or c >= 128:
            table[c] = c
        elif ord("A") <= c <= ord("Z"):
            table[c] = c + 32
    return table


def letter_grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts one after another, and how many each text has.

    Runs of bytes that are no letters count as one blank.
    """
    pad = bytes([END]) * order
    raw = np.frombuffer(b"".join([pad + x + b"\n" for x in texts]), np.uint8)
    sizes = np.array([len(x) + order + 1 for x in texts], np.int64)
    begins = starts_of(sizes)
    data = letter_table()[raw]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != BLANK) | (data[:-1] != BLANK)
    for j in range(order):
        data[begins + j], keep[begins + j] = END, True
    last = begins + sizes - 1
    data[last], keep[last] = END, True
    kept = np.add.reduceat(keep, begins, dtype=np.int64) if len(texts) else sizes
    data = data[keep]
    grams = gram_keys(data.tobytes(), order)
    inside = np.ones(len(data), bool)
    begins = starts_of(kept)
    for j in range(order):
        inside[begins + j] = False
    return grams[inside[order:]], kept - order


def stretches(text: bytes, order: int, most: int) -> Iterator[np.ndarray]:
    """The grams of one text as ``letter_grams`` gives them, about ``most`` at a time."""
    table = bytes(letter_table())
    data = bytes([END]) * order + re.sub(b" +", b" ", text.translate(table)) + bytes([END])
    for start in range(0, len(data) - order, most):
        yield gram_keys(data[start : start + most + order], order)


def has_letter(text: bytes) -> bool:
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in text[:64]):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def learn_trees(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    order: int = ORDER,
    sample_bytes: int = SAMPLE,
) -> dict[str, tuple[bytes, bytes]]:
    """The packed grams and counts of each language, from rows for which ``learn`` holds.

    Rows with a null text or label teach nothing. A block's place in the sample depends on
    the row's key and text and its number there only; the first block of each language by
    place is always taken, so every label has a tree. Without such rows the model has no
    language.
    """
    rows = docs.where(learn).select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("binary").alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("row"),
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    last = F.greatest(F.lit(0), F.floor((F.octet_length("text") - 1) / BLOCK).cast("int"))
    blocks = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    blocks = blocks.withColumn("place", F.pmod(F.xxhash64("row", "block"), F.lit(1_000_000)))
    size = F.least(F.lit(BLOCK), F.octet_length("text") - F.col("block") * BLOCK)
    sizes = blocks.groupBy("lang").agg(F.sum(size).alias("bytes"), F.min("place").alias("first")).collect()
    if not sizes:
        return {}
    # Places below the limit are taken.
    limits = [(r["lang"], max(r["first"] + 1.0, 1e6 * sample_bytes / max(1, r["bytes"]))) for r in sizes]
    limit = F.create_map(*[F.lit(x) for pair in limits for x in pair])
    sample = blocks.where(F.col("place") < limit[F.col("lang")]).select(
        "lang", F.substring("text", F.col("block") * BLOCK + 1, F.lit(BLOCK)).alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text", CHUNK):
            labels = part.column("lang").to_pylist()
            for one in sorted(set(labels)):
                grams, _ = letter_grams([t for t, x in zip(texts, labels) if x == one], order)
                values = packed_counts(one, *counted(grams))
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], TREE)

    def add(table: pa.Table) -> pa.Table:
        grams = [unpacked_sorted(x) for x in table.column("grams").to_pylist()]
        counts = [unpacked(x, np.int64) for x in table.column("counts").to_pylist()]
        one = table.column("lang")[0].as_py()
        values = packed_counts(one, *merged(np.concatenate(grams), np.concatenate(counts)))
        return pa.table([pa.array([v]) for v in values], names=TREE)

    schema = "lang string, grams binary, counts binary"
    trees = sample.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema)
    return {r["lang"]: (r["grams"], r["counts"]) for r in trees.collect()}


def packed_counts(lang: str, grams: np.ndarray, counts: np.ndarray) -> tuple[str, bytes, bytes]:
    return lang, packed_sorted(grams), packed(counts.astype(np.int64))


class Languages:
    """All trees, and the log-probabilities of every gram that any of them has."""

    def __init__(self, trees: dict[str, tuple[bytes, bytes]], order: int):
        self.names = sorted(trees)
        self.tries = []
        for name in self.names:
            grams, counts = unpacked_sorted(trees[name][0]), unpacked(trees[name][1], np.int64)
            self.tries.append(Trie(grams, counts, byte_pairs(grams, counts), order))
        self.known = Places(np.unique(np.concatenate([t.levels[order].grams for t in self.tries])))
        self.logs = self.log_matrix(self.known.table)

    def log_matrix(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([t.log_probabilities(grams) for t in self.tries])

    def code_lengths(self, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The log-probability of each text in each language."""
        place, found = self.known.find(grams)
        new, back = np.unique(grams[~found], return_inverse=True)
        new_logs = self.log_matrix(new)
        begins = starts_of(sizes)
        sums = np.empty((len(self.names), len(sizes)))
        for i in range(len(self.names)):
            logs = self.logs[i][place]
            logs[~found] = new_logs[i][back]
            sums[i] = np.add.reduceat(logs, begins)
        return sums

    def text_lengths(self, texts: list[bytes], order: int, most: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """``code_lengths`` of whole texts, and how many bytes of each count; long ones by the stretch."""
        sums, sizes = np.zeros((len(self.names), len(texts))), np.zeros(len(texts), np.int64)
        short = [i for i, t in enumerate(texts) if len(t) <= most]
        if short:
            grams, sizes[short] = letter_grams([texts[i] for i in short], order)
            sums[:, short] = self.code_lengths(grams, sizes[short])
        for i, text in enumerate(texts):
            if len(text) > most:
                for grams in stretches(text, order, most):
                    sums[:, i] += self.code_lengths(grams, np.array([len(grams)]))[:, 0]
                    sizes[i] += len(grams)
        return sums, sizes


def predict_language(
    docs: DataFrame, trees: dict[str, tuple[bytes, bytes]], text: str = "text", order: int = ORDER, most: int = CHUNK
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``code_bits`` and ``code_bytes``, in place of columns of these names.

    ``lang_pred`` is the language that codes the whole text shortest, the first by name
    in a tie; ``score`` is its posterior probability if all are equally likely before.
    A text that is null, empty or without a letter is ``und`` with score 0, and so is
    every text if no language was learned. ``code_bits`` is how many bits a byte the text takes
    in that language, and ``code_bytes`` how many bytes count, runs of other bytes than letters
    as one; both are 0 for ``und``. Texts of more than ``most`` bytes are coded by the stretch.
    Equal rows get equal results.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trees)
    added = T.StructType.fromDDL("lang_pred string, score double, code_bits double, code_bytes long")
    columns = [n for n in docs.columns if n not in added.names]
    schema = T.StructType([*[docs.schema[n] for n in columns], *added.fields])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = Languages(model.value, order) if model.value else None
        for part, texts in pieces(batches, text, CHUNK):
            known = [languages is not None and has_letter(t) for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            bits, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            rows = [i for i, k in enumerate(known) if k]
            if rows:
                logs, sizes[rows] = languages.text_lengths([texts[i] for i in rows], order, most)
                bits[rows] = -logs.max(axis=0) / sizes[rows] / np.log(2)
                best = logs.argmax(axis=0)
                top = 1 / np.exp(logs - logs.max(axis=0)).sum(axis=0)
                for i, b, s in zip(rows, best.tolist(), top.tolist()):
                    names[i], scores[i] = languages.names[b], s
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(n) for n in columns],
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(bits),
                    pa.array(sizes),
                ],
                [*columns, *added.names],
            )

    return docs.select(*columns).mapInArrow(predict, schema)


def usual_bits(predicted: DataFrame) -> dict[str, tuple[float, float]]:
    """The mean and spread of ``code_bits`` of each language's texts: one partial aggregate, a row a language."""
    known = predicted.where(F.col("lang_pred") != UNKNOWN).groupBy("lang_pred")
    found = known.agg(F.avg("code_bits").alias("mean"), F.stddev_pop("code_bits").alias("spread"))
    return {r["lang_pred"]: (r["mean"], r["spread"]) for r in found.collect()}


def is_foreign(usual: dict[str, tuple[float, float]], far: float = FAR, short: float = SHORT) -> Column:
    """Whether a predicted text's code takes many more bits than the texts of its language usually do.

    A text of a language that was never learned, or of letters at random, has some learned language
    that codes it shortest, and by far; what tells it apart is that no language codes it short. A
    language without usual bits has the highest limit of the others; without any, no text is foreign.
    """
    limits = {name: mean + far * max(spread, LEAST_SPREAD) for name, (mean, spread) in usual.items()}
    limit = F.lit(max(limits.values(), default=float("inf")))
    for name, most in limits.items():
        limit = F.when(F.col("lang_pred") == name, most).otherwise(limit)
    return F.col("code_bits") > limit + short / F.sqrt("code_bytes")
