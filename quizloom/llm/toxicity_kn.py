"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts.

Both discount their own word counts and give what is left to one shared lower order,
the continuation counts: in how many distinct contexts a word occurs in either class.
A rare expression is thus about as likely in both. A toxic text is mostly ordinary
words, so its words come from the ordinary model but for a small share; a text's score
is the log-likelihood ratio by its words, over their number, set against a threshold
found on labelled texts that the counts haven't seen.

The models learn from at most about ``SAMPLE`` labelled texts of each class, so their
word table is bounded and can be sent to every task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, pieces
from quizloom.staging import staged

#: Labelled texts to learn from, of each class; to find the threshold, as many again.
SAMPLE = 8000
#: Discounts of ordinary and toxic word counts, and of continuation counts.
ORDINARY_DISCOUNT, TOXIC_DISCOUNT, SHARED_DISCOUNT = 0.75, 2.0, 0.5
#: The share of a toxic text's words that comes from the toxic model.
TOXIC_SHARE = 0.01
#: Words with fewer occurrences in the sample say nothing; at 1 discounts and shared counts alone decide.
LEAST_COUNT = 1

#: ASCII characters that are no letter or digit part words; A-Z become a-z.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Toxicity:
    """What scoring needs: a log-ratio for each word, the threshold and the scale around it."""

    def __init__(self, ratios: dict[bytes, float], threshold: float, scale: float):
        self.ratios, self.threshold, self.scale = ratios, threshold, scale

    def values(self) -> tuple:
        """What to broadcast: plain values, as workers may not have this module."""
        return self.ratios, self.threshold, self.scale

    def mean_ratio(self, text: bytes) -> float:
        words = words_of(text)
        return sum(map(self.ratios.get, words, repeat(0.0))) / len(words) if words else 0.0

    def score(self, text: bytes) -> float:
        at = (self.mean_ratio(text) - self.threshold) / self.scale
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each class at most, ``weight`` raised by what is left out.

    Which rows are taken depends on the rows alone.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    share = F.lit(1.0)
    for toxic, n in sizes.items():
        share = F.when(F.col("toxic") == toxic, min(1.0, most / n)).otherwise(share)
    place = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 52))
    return rows.where(place < share * (1 << 52)).withColumn("weight", F.col("weight") / share)


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word follows each other one, by class."""
    for part, texts in pieces(batches, "text", 4 * MB):
        toxic = part.column("toxic").to_pylist()
        counts = Counter(), Counter()
        for text, t in zip(texts, toxic):
            words = words_of(text)
            counts[t].update(zip([b"", *words], words))
        pairs = [*counts[0].keys(), *(p for p in counts[1] if p not in counts[0])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], pa.binary()),
                pa.array([p[1] for p in pairs], pa.binary()),
                pa.array([counts[0][p] for p in pairs], pa.int64()),
                pa.array([counts[1][p] for p in pairs], pa.int64()),
            ],
            ["before", "word", "ordinary", "toxic"],
        )


def word_ratios(sample: DataFrame, toxic_share: float, least_count: int) -> dict[bytes, float]:
    """The log of how much likelier each word is in a toxic text, by the two models."""
    pairs = sample.mapInArrow(contexts, "before binary, word binary, ordinary long, toxic long")
    words = staged(
        pairs.groupBy("word", "before")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
        .groupBy("word")
        .agg(
            F.sum("ordinary").alias("ordinary"),
            F.sum("toxic").alias("toxic"),
            F.count(F.lit(1)).alias("contexts"),
        ),
        "toxic-words",
    )
    discounts = {"ordinary": ORDINARY_DISCOUNT, "toxic": TOXIC_DISCOUNT}
    totals = words.agg(
        F.sum("contexts").alias("contexts"),
        *[F.sum(c).alias(c) for c in discounts],
        *[F.sum(F.least(F.col(c).cast("double"), F.lit(d))).alias(f"{c}_left") for c, d in discounts.items()],
    ).first()
    if not totals["ordinary"] or not totals["toxic"]:
        return {}
    shared = F.greatest(F.col("contexts") - SHARED_DISCOUNT, F.lit(SHARED_DISCOUNT)) / totals["contexts"]

    def likelihood(name: str) -> Column:
        own = F.greatest(F.col(name) - F.lit(discounts[name]), F.lit(0.0))
        return (own + totals[f"{name}_left"] * shared) / totals[name]

    ratio = F.log(1 - toxic_share + toxic_share * likelihood("toxic") / likelihood("ordinary"))
    known = words.where(F.col("ordinary") + F.col("toxic") >= least_count)
    return {bytes(r[0]): r[1] for r in known.select("word", ratio).collect()}


def threshold_of(means: np.ndarray, toxic: np.ndarray, weights: np.ndarray | None = None) -> tuple[float, float]:
    """The mean ratio that parts the classes with the best F1, and the scale to score by.

    ``weights`` are the rows that each one stands for.
    """
    weights = np.ones(len(means)) if weights is None else weights
    order = np.lexsort((weights, -means))
    means, toxic, weights = means[order], toxic[order], weights[order]
    hits = np.cumsum(weights * toxic)
    f1 = 2 * hits / (np.cumsum(weights) + max(1, hits[-1]))
    # Only between different values; of equal ones the highest.
    edge = np.append(means[1:] < means[:-1], True)
    best = int(np.where(edge, f1, -1).argmax())
    below = means[best + 1] if best + 1 < len(means) else means[best] - 1e-3
    return float((means[best] + below) / 2), max(1e-3, float(np.std(means[~toxic])))


def learn_toxicity(
    rows: DataFrame, sample: int = SAMPLE, toxic_share: float = TOXIC_SHARE, least_count: int = LEAST_COUNT
) -> Toxicity:
    """A model from labelled rows: ``key``, ``text`` (binary), ``toxic`` (0 or 1), ``check`` (boolean).

    Rows with ``check`` give the threshold, the others the counts. Rows with a null in any
    of these columns teach nothing. Without rows of both classes all scores are 0.5 or less.
    If the rows are a sample, ``weight`` is the number of rows that each stands for; the
    threshold is that of their natural mix. Without toxic rows with ``check`` it is the
    largest mean ratio of the others.
    """
    rows = rows.where("text IS NOT NULL AND toxic IN (0, 1)")
    if "weight" not in rows.columns:
        rows = rows.withColumn("weight", F.lit(1.0))
    ratios = word_ratios(sampled(rows.where("NOT check"), sample), toxic_share, least_count)
    model = Toxicity(ratios, 0.0, 1e-3)
    share = rows.sparkSession.sparkContext.broadcast(model.values())

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Toxicity(*share.value)
        for part, texts in pieces(batches, "text", 4 * MB):
            values = [known.mean_ratio(t) for t in texts]
            rest = [part.column(n) for n in ("toxic", "weight")]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), *rest], ["x", "toxic", "weight"])

    # Each class apart, so that a rare one is there; weights give back the natural mix.
    kept = sampled(rows.where("check"), sample).select("text", "toxic", "weight")
    found = kept.mapInArrow(means, "x double, toxic int, weight double").collect()
    x, weights = (np.array([r[n] for r in found], float) for n in ("x", "weight"))
    toxic = np.array([r["toxic"] for r in found], bool)
    if not ratios or toxic.all():
        return Toxicity(ratios, 1e-3, 1e-3)
    if not toxic.any():
        scale = max(1e-3, float(np.std(x)))
        return Toxicity(ratios, max(0.0, float(x.max())) + 1e-3, scale)
    return Toxicity(ratios, *threshold_of(x, toxic, weights))


def score_toxicity(docs: DataFrame, model: Toxicity, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if it is 0.5 or more), in place of such columns.

    A null or empty text, or one without words, has a mean ratio of 0. Equal texts get
    equal scores, an empty table stays empty.
    """
    columns = [n for n in docs.columns if n not in ("score", "predicted")]
    share = docs.sparkSession.sparkContext.broadcast(model.values())

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Toxicity(*share.value)
        for part, texts in pieces(batches, text, 4 * MB):
            values = [known.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(n) for n in columns],
                    pa.array(values, pa.float64()),
                    pa.array([int(v >= 0.5) for v in values], pa.int32()),
                ],
                [*columns, "score", "predicted"],
            )

    added = T.StructType.fromDDL("score double, predicted int").fields
    schema = T.StructType([*[docs.schema[n] for n in columns], *added])
    return docs.select(*columns).mapInArrow(scores, schema)
