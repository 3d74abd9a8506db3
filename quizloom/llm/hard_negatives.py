"""Hard-negative mining with Strassen products of integer tiles.

Vectors become whole numbers. Anchors and candidates are dealt out into blocks by a hash of
their row, and each pair of an anchor block and a candidate block is a tile: an exact
``int64`` matrix product by Strassen's recursion, padded with zeros where a side is odd.
Heaps of a fixed size go from tile to tile and are merged: first each anchor's best
candidates of its own label, its positives, then, with those known, the best candidates of
other labels in each positive's window of scores. A task holds one tile and the heaps of
one anchor block; what it hands on is a heap for each anchor, never a score for each pair.

Sums that wrap around at 64 bits on the way cancel out again, since whole numbers modulo
2^64 are a ring; the scores themselves fit (``LARGEST_SCORE``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import packed, sorted_groups, unpacked
from quizloom.staging import ROW, staged, staged_with_row

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Anchors and candidates of a tile, if their vectors have 64 components; longer ones make smaller tiles.
ANCHORS, CANDIDATES = 512, 2048
#: Sides up to which a product is taken directly.
LEAF = 32
#: A hundred times a score must fit into 64 bits.
LARGEST_SCORE = 1 << 56
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The exact product of two ``int64`` matrices of any shape."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    top, mid, left = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:top, :mid], a[:top, mid:], a[top:, :mid], a[top:, mid:]
    b11, b12, b21, b22 = b[:mid, :left], b[:mid, left:], b[mid:, :left], b[mid:, left:]
    product = np.zeros((a.shape[0], b.shape[1]), np.int64)
    c11, c12, c21, c22 = product[:top, :left], product[:top, left:], product[top:, :left], product[top:, left:]
    for x, y, plus, minus in (
        (a11 + a22, b11 + b22, (c11, c22), ()),
        (a21 + a22, b11, (c21,), (c22,)),
        (a11, b12 - b22, (c12, c22), ()),
        (a22, b21 - b11, (c11, c21), ()),
        (a11 + a12, b22, (c12,), (c11,)),
        (a21 - a11, b11 + b12, (c22,), ()),
        (a12 - a22, b21 + b22, (c11,), ()),
    ):
        part = strassen(x, y, leaf)
        for c in plus:
            c += part
        for c in minus:
            c -= part
    return product[:m, :n]


def best(owner: np.ndarray, rows: dict[str, np.ndarray], most: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The first ``most`` of each owner's rows: highest ``score``, then smallest ``id``, then ``row``."""
    order = np.lexsort((rows["row"], rows["id"], ~rows["score"], owner))
    owner = owner[order]
    new = np.concatenate(([True], owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    nth = np.arange(len(owner)) - np.repeat(starts, np.diff(starts, append=len(owner)))
    first = order[nth < most]
    return owner[nth < most], {k: v[first] for k, v in rows.items()}


def merged(heap, owner, rows, most):
    """Two heaps as one."""
    if heap is None:
        return best(owner, rows, most)
    return best(np.concatenate((heap[0], owner)), {k: np.concatenate((heap[1][k], v)) for k, v in rows.items()}, most)


def chosen(scores: np.ndarray, allowed: np.ndarray, most: int, known: dict[str, np.ndarray]):
    """The cells of a tile that may be among the first ``most`` of their row, ties included."""
    held = np.where(allowed, scores, NONE)
    if held.shape[1] > most:
        least = np.partition(held, held.shape[1] - most, axis=1)[:, -most]
        allowed = allowed & (held >= least[:, None])
    at, which = np.nonzero(allowed)
    return at, {"score": scores[at, which], "id": known["id"][which], "row": known["row"][which]}


PACKED = "size int, block int, n int, id binary, row binary, label binary, scores binary, vectors binary"


def packer(positives: int):
    """Sorted rows to one row for each block, its columns packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["size", "block"]):
            size, n = group.column("size")[0].as_py(), len(group)
            known = np.full((n, positives), NONE)
            lists = group.column("scores").combine_chunks()
            counts = np.diff(lists.offsets.to_numpy())
            at = np.repeat(np.arange(n), counts)
            known[at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)] = lists.flatten().to_numpy()
            flat = group.column("vector").combine_chunks().flatten().to_numpy()
            columns = [group.column(c).to_numpy() for c in ("id", "row", "label")]
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array([size], pa.int32()),
                    "block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                    "n": pa.array([n], pa.int32()),
                    **{c: [packed(v.astype(np.int64))] for c, v in zip(("id", "row", "label"), columns)},
                    "scores": [packed(known)],
                    "vectors": [packed(flat.astype(np.int64))],
                }
            )

    return pack


def opened(row: dict, side: str) -> dict[str, np.ndarray]:
    columns = {c: unpacked(row[f"{side}_{c}"], np.int64) for c in ("id", "row", "label", "scores", "vectors")}
    for c in ("scores", "vectors"):
        columns[c] = columns[c].reshape(row[f"{side}_n"], -1)
    return columns


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The scores of each tile, with both sides; an anchor block is opened once while it stays the same."""
    before, anchors = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            this = (row["size"], row["anchor_block"])
            if this != before:
                before, anchors = this, opened(row, "anchor")
            others = opened(row, "candidate")
            yield this, anchors, others, strassen(anchors["vectors"], np.ascontiguousarray(others["vectors"].T))


HEAP = "owner long, place int, score long, id long, row long"


def heap_rows(anchors: dict, heap, positives: int) -> Iterator[pa.RecordBatch]:
    if heap is not None and len(heap[0]):
        at, place = np.divmod(heap[0], positives)
        yield pa.RecordBatch.from_pydict(
            {"owner": anchors["row"][at], "place": place.astype(np.int32), **{c: heap[1][c] for c in ("score", "id", "row")}}
        )


def kept(select, most: int, positives: int):
    """Tiles to heaps: those of an anchor block are merged for as long as its tiles follow one another."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, heap = None, None, None
        for this, anchors, others, scores in tiles(batches):
            if this != before and before is not None:
                yield from heap_rows(held, heap, positives)
                heap = None
            before, held = this, anchors
            for place, allowed in select(anchors, others, scores):
                at, rows = chosen(scores, allowed, most, others)
                heap = merged(heap, at * positives + place, rows, most)
        if before is not None:
            yield from heap_rows(held, heap, positives)

    return keep


def same_label(anchors, others, scores):
    same = anchors["label"][:, None] == others["label"][None, :]
    yield 0, same & (anchors["row"][:, None] != others["row"][None, :])


def in_windows(low: int, high: int):
    """Cells of another label with ``low * positive <= 100 * score <= high * positive``, for each positive."""

    def select(anchors, others, scores):
        differs = anchors["label"][:, None] != others["label"][None, :]
        hundred = 100 * scores
        for place in range(anchors["scores"].shape[1]):
            positive = anchors["scores"][:, place, None]
            there = differs & (positive != NONE)
            positive = np.where(positive == NONE, 0, positive)
            yield place, there & (hundred >= low * positive) & (hundred <= high * positive)

    return select


def blocks_of(rows: DataFrame, blocks: DataFrame, name: str, positives: int) -> DataFrame:
    """``rows`` packed into the number of blocks that ``blocks`` gives for their size, one row each."""
    dealt = rows.join(blocks.select("size", F.col(name).alias("_blocks")), "size").select(
        "size", F.pmod(F.xxhash64("row"), F.col("_blocks")).cast("int").alias("block"),
        "id", "row", "label", "scores", "vector",
    )
    grouped = dealt.repartition("size", "block").sortWithinPartitions("size", "block")
    return grouped.mapInArrow(packer(positives), PACKED)


def tiled(anchors: DataFrame, candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every anchor block beside every candidate block of the same size."""
    columns = ["n", "id", "row", "label", "scores", "vectors"]
    one = anchors.join(blocks, "size").select(
        "size", F.col("block").alias("anchor_block"),
        F.explode(F.sequence(F.lit(0), F.col("candidates") - 1)).alias("candidate_block"),
        *[F.col(c).alias(f"anchor_{c}") for c in columns],
    )
    other = candidates.join(blocks, "size").select(
        "size", F.explode(F.sequence(F.lit(0), F.col("anchors") - 1)).alias("anchor_block"),
        F.col("block").alias("candidate_block"),
        *[F.col(c).alias(f"candidate_{c}") for c in columns],
    )
    return one.hint("merge").join(other, ["size", "anchor_block", "candidate_block"])


def sound_rows(
    vectors: DataFrame, key: Column, vector: Column, label: Column, anchor: Column, factor: int
) -> DataFrame:
    """Rows that take part: ``id``, ``row``, ``label``, ``anchor``, ``size`` and whole numbers ``vector``."""
    rows = staged_with_row(
        vectors.select(
            key.cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        ),
        "mining-rows",
    )
    size = F.size("vector")
    most = F.sqrt(F.lit(float(LARGEST_SCORE)) / F.greatest(size, F.lit(1)))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * factor) < most))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return rows.where(sound).select("id", F.col(ROW).alias("row"), "label", "anchor", size.alias("size"), whole.alias("vector"))


def first_of(heaps: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first ``most`` of each owner's rows from all tasks, with their ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    factor: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """The best negatives in the window of each positive of each anchor.

    A row's score is its inner product with the anchor, both of ``floor(factor * x)``; higher
    ones come first, of equal ones the smaller key. Positives are the first ``positives``
    other rows of the anchor's label, negatives the first ``negatives`` of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``. Columns:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``; anchors without a positive, and windows without a row, give none.

    Rows with a null key, label or vector, or a null, NaN or infinite component take no part,
    nor do those with a component so large that a score might not fit (``LARGEST_SCORE``:
    33 million for 64 components). Vectors of different lengths are not compared; empty ones
    score 0. Repeated rows count each, as anchors too; rows of equal score and key come in
    the order of the table. An empty table gives an empty table. Other columns are not read.
    """
    label = F.col("label") if label is None else label
    rows = staged(
        sound_rows(vectors, F.col(key), F.col(vector), label, anchor, factor)
        .withColumn("scores", F.expr("CAST(array() AS array<bigint>)")),
        "mining",
    )
    # One row for each length; a tile holds about as many numbers whatever the length.
    share = F.least(F.lit(1.0), F.lit(64.0) / F.greatest("size", F.lit(1)))
    blocks = staged(
        rows.groupBy("size").agg(F.count_if("anchor").alias("n"), F.count(F.lit(1)).alias("all")).where("n > 0").select(
            "size",
            F.ceil(F.col("n") / F.greatest(F.lit(ANCHORS) * share, F.lit(1))).cast("int").alias("anchors"),
            F.ceil(F.col("all") / F.greatest(F.lit(CANDIDATES) * share, F.lit(1))).cast("int").alias("candidates"),
        ),
        "mining-blocks",
    )
    candidates = staged(blocks_of(rows, blocks, "candidates", positives), "candidate-blocks")
    asked = rows.where("anchor")
    pairs = tiled(blocks_of(asked, blocks, "anchors", positives), candidates, blocks)
    heaps = staged(pairs.mapInArrow(kept(same_label, positives, 1), HEAP), "positive-heaps")
    near = staged(first_of(heaps.drop("place"), ["owner"], positives), "positives")
    scores = near.groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_near"))
    scores = scores.select(F.col("owner").alias("row"), F.col("_near.score").alias("scores"))
    asked = asked.drop("scores").join(scores, "row")
    pairs = tiled(blocks_of(asked, blocks, "anchors", positives), candidates, blocks)
    heaps = staged(pairs.mapInArrow(kept(in_windows(low, high), negatives, positives), HEAP), "negative-heaps")
    hard = first_of(heaps, ["owner", "place"], negatives)
    positive = near.select(
        "owner", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    names = rows.where("anchor").select(F.col("row").alias("owner"), F.col("id").alias("anchor_id"))
    return (
        hard.select("owner", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(positive, ["owner", "place"])
        .join(names, "owner")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
