"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. A line's potential is linear in its own features and those of
the lines before and after it; two neighbouring lines add a potential of their pair.
Forward-backward gives the probability that each line is good, and their mean weighted
by length is the document's score.

Labels are known for documents only, so in training every line has its document's
label. The field learns on the driver from at most ``SAMPLE`` documents of each class, of
a longer one from ``MOST_LINES`` lines in a row from a place that its hash names; scoring
is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, packed, pieces, starts_of, unpacked

#: Labelled documents to learn from, of each class, and the most lines of each.
SAMPLE = 1500
MOST_LINES = 300
ROUNDS = 150
RATE = 0.1
PENALTY = 1e-3
CHUNK = 4 * MB

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
#: Marks of ordinary prose aren't counted.
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-")
HIGH = bytes(range(128, 256))
FEATURES = 9


def line_features(line: bytes, before: bytes | None) -> tuple[float, ...]:
    """Length, shares of characters, and how its words repeat."""
    n, words = len(line), line.split()
    if not words:
        return (0.0,) * FEATURES

    def share(characters: bytes) -> float:
        return 1 - len(line.translate(None, characters)) / n

    return (
        np.log1p(n),
        share(UPPER),
        share(DIGITS),
        share(SYMBOLS),
        share(HIGH),
        min(40, n / len(words)),
        1 - len(set(words)) / len(words),
        sum(len(w) <= 3 for w in words) / len(words),
        float(line == before),
    )


def text_features(text: bytes, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The features of each line, and the lines' lengths; of ``most`` lines in a row if there are more."""
    if not text:
        return np.empty((0, FEATURES)), np.empty(0, np.int64)
    lines = text.split(b"\n")
    befores = [None, *lines]
    if most and len(lines) > most:
        first = xxhash.xxh64_intdigest(text) % (len(lines) - most + 1)
        lines, befores = lines[first : first + most], befores[first : first + most]
    rows = [line_features(line, before) for line, before in zip(lines, befores)]
    return np.array(rows), np.array([len(line) for line in lines], np.int64)


def with_neighbours(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A line's own features, those of the lines around it in its document (zeros beyond), and a one."""
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    full = sizes > 0
    begins = starts_of(sizes)[full]
    before[begins] = 0
    after[begins + sizes[full] - 1] = 0
    return np.hstack((rows, before, after, np.ones((len(rows), 1))))


class Field:
    """Weights of the lines' features, the pair potentials [before, after], and the features' scale."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray, mean: np.ndarray, spread: np.ndarray, prior: float):
        self.weights, self.pairs, self.mean, self.spread, self.prior = weights, pairs, mean, spread, prior

    def inputs(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return with_neighbours(np.clip((rows - self.mean) / self.spread, -5, 5), sizes)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The mean probability that a line is good, by length; texts without characters have the prior."""
        found = [text_features(t) for t in texts]
        sizes = np.array([len(n) for _, n in found], np.int64)
        result = np.full(len(texts), self.prior)
        if not sizes.any():
            return result
        lengths = np.concatenate([n for _, n in found]).astype(np.float64)
        inputs = self.inputs(np.concatenate([r for r, _ in found]), sizes)
        good, _, _ = forward_backward(inputs @ self.weights, self.pairs, sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        total = np.bincount(owner, lengths, len(texts))
        sums = np.bincount(owner, lengths * good, len(texts))
        some = total > 0
        result[some] = sums[some] / total[some]
        return np.clip(result, 0, 1)


def forward_backward(potential: np.ndarray, pairs: np.ndarray, sizes: np.ndarray):
    """P(good) of each line, the expected pairs, and the log of each document's sum over labellings.

    ``potential`` is that of good against bad. All documents go together, one line at a
    time; those with fewer lines drop out.
    """
    at = np.argsort(-sizes, kind="stable")
    at = at[sizes[at] > 0]
    begins, ordered = starts_of(sizes)[at], sizes[at]
    nodes = np.stack((np.zeros(len(potential)), potential), axis=1)
    forward, backward = np.empty_like(nodes), np.zeros_like(nodes)
    longest = int(ordered[0]) if len(at) else 0
    active = [int(np.searchsorted(-ordered, -t, side="left")) for t in range(longest)]
    forward[begins] = nodes[begins]
    for t in range(1, longest):
        here = begins[: active[t]] + t
        steps = forward[here - 1][:, :, None] + pairs
        forward[here] = np.logaddexp(steps[:, 0], steps[:, 1]) + nodes[here]
    for t in range(longest - 2, -1, -1):
        here = begins[: active[t + 1]] + t
        steps = pairs + (nodes[here + 1] + backward[here + 1])[:, None, :]
        backward[here] = np.logaddexp(steps[:, :, 0], steps[:, :, 1])
    last = begins + ordered - 1
    totals = np.zeros(len(sizes))
    totals[at] = np.logaddexp(forward[last, 0], forward[last, 1])
    of_line = np.repeat(totals, sizes)
    good = np.exp(forward[:, 1] + backward[:, 1] - of_line)
    inner = np.ones(len(nodes), bool)
    inner[begins] = False
    second = np.flatnonzero(inner)
    joint = (
        forward[second - 1][:, :, None] + pairs + (nodes[second] + backward[second])[:, None, :]
    ) - of_line[second][:, None, None]
    return good, np.exp(joint).sum(axis=0), totals


def fitted(rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Gradient steps (Adam) on the mean log-likelihood of the labellings, each class with half the weight."""
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    field = Field(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), mean, spread, float(labels.mean()))
    inputs = field.inputs(rows, sizes)
    line_labels = np.repeat(labels, sizes).astype(np.float64)
    shares = np.where(labels, 0.5 / max(1, labels.sum()), 0.5 / max(1, (~labels).sum()))
    line_shares = np.repeat(shares / np.maximum(1, sizes), sizes)
    inner = np.ones(len(rows), bool)
    inner[starts_of(sizes)[sizes > 0]] = False
    observed = np.zeros((2, 2))
    observed[1, 1], observed[0, 0] = (line_labels[inner] == 1).sum(), (line_labels[inner] == 0).sum()
    moments = [np.zeros(len(field.weights) + 4) for _ in range(2)]
    for n in range(1, rounds + 1):
        good, expected, _ = forward_backward(inputs @ field.weights, field.pairs, sizes)
        slope = inputs.T @ ((line_labels - good) * line_shares) - PENALTY * field.weights
        pair_slope = (observed - expected) / max(1, inner.sum()) - PENALTY * field.pairs
        gradient = np.concatenate((slope, pair_slope.ravel()))
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        step = RATE * (moments[0] / (1 - 0.9**n)) / (np.sqrt(moments[1] / (1 - 0.99**n)) + 1e-8)
        field.weights = field.weights + step[:-4]
        field.pairs = field.pairs + step[-4:].reshape(2, 2)
    return field


def learn_quality(
    rows: DataFrame, sample: int = SAMPLE, most_lines: int = MOST_LINES, prior: float | None = None
) -> Field:
    """A field from labelled rows: ``key``, ``text`` (binary), ``quality`` (0 or 1).

    Rows with a null text or label teach nothing, nor do empty texts. Which rows are
    taken depends on the rows alone, and so does which stretch of a text with more than
    ``most_lines`` lines. Without any, every score is 0.5. ``prior`` is the share of good
    documents if ``rows`` are a sample that changes it.
    """
    rows = rows.where("text IS NOT NULL AND octet_length(text) > 0 AND quality IN (0, 1)")
    sizes = {r[0]: r[1] for r in rows.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("quality") == label, min(1.0, sample / n)).otherwise(share)
    place = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 52))
    taken = rows.where(place < share * (1 << 52)).select("quality", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text", CHUNK):
            found = [packed(text_features(t, most_lines)[0]) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(found)], ["quality", "rows"])

    found = taken.mapInArrow(features, "quality int, rows binary").orderBy("quality", "rows").collect()
    if not found:
        return Field(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), np.zeros(FEATURES), np.ones(FEATURES), 0.5)
    lines = [unpacked(bytes(r["rows"]), np.float64).reshape(-1, FEATURES) for r in found]
    labels = np.array([r["quality"] for r in found], bool)
    field = fitted(np.concatenate(lines), np.array([len(x) for x in lines], np.int64), labels)
    field.prior = sizes.get(1, 0) / sum(sizes.values()) if prior is None else prior
    return field


def score_quality(docs: DataFrame, field: Field, text: str = "text", least: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if ``least`` or more), in place of such columns.

    A null or empty text, or one of line ends only, has the share of good documents in
    training as its score. Equal texts get equal scores, an empty table stays empty.
    """
    columns = [n for n in docs.columns if n not in ("score", "predicted")]
    # Plain values: broadcasts, unlike functions, are read by workers that may not have this module.
    share = docs.sparkSession.sparkContext.broadcast(
        (field.weights, field.pairs, field.mean, field.spread, float(field.prior))
    )

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Field(*share.value)
        for part, texts in pieces(batches, text, CHUNK):
            values = known.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(n) for n in columns],
                    pa.array(values),
                    pa.array((values >= least).astype(np.int32)),
                ],
                [*columns, "score", "predicted"],
            )

    added = T.StructType.fromDDL("score double, predicted int").fields
    schema = T.StructType([*[docs.schema[n] for n in columns], *added])
    return docs.select(*columns).mapInArrow(scores, schema)
