"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints within ``b`` bits agree wholly in one of ``b + 1`` blocks of bits. For each
block there is a trie in which that block comes first; only its nodes below one value of
the block are paired, so a block's value is the unit that Spark deals out. In a task the
fingerprints are sorted, a trie node is a range of them, and pairs of nodes go down
together, one bit at a time: equal children keep the differing bits, unequal ones add
one, and a pair beyond the budget is dropped.

Links are not emitted: a task hands on only a link from each fingerprint to the smallest
one of its component there. Node pairs whose fingerprints are all in one component
already are dropped, so a dense group isn't walked pair by pair. Copies count once:
only distinct fingerprints take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import MB, pieces, text_hash
from quizloom.llm.components import Forest, components
from quizloom.staging import staged

WORDS = 4
MOST_BITS = 4
SEED = 42
#: Rows of a task of the self-join, and node pairs that it goes down with at once.
TASK_ROWS = 200_000
PAIRS = 1 << 18
BITS = 64


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bit i is set if it is in over half of the hashes of the word shingles, repeats included."""
    split = text.lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    if len(split) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(sizes + 1) - sizes - 1
    stops = (starts + sizes)[words - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 18):
        part = np.ascontiguousarray(hashes[at : at + (1 << 18)].astype(">u8"))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key``, ``text_hash`` and ``fp`` (a signed long) of each row's whole text; null is empty."""
    rows = docs.select(
        F.col(key).alias("key"), text_hash(text).alias("text_hash"), F.col(text).cast("binary").alias("text")
    )

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text", 4 * MB):
            values = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("text_hash"), pa.array(values)], ["key", "text_hash", "fp"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(prints, f"key {kind}, text_hash long, fp long")


def blocks_of(most_bits: int) -> list[tuple[int, int]]:
    """The first bit and the width of each block, from the highest bit."""
    edges = [round(i * BITS / (most_bits + 1)) for i in range(most_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def self_join(values: np.ndarray, tops: np.ndarray, depth: int, budget: int, forest: Forest) -> None:
    """Link in ``forest`` all places of the sorted ``values`` within ``budget`` bits below equal tops.

    ``tops`` tells which trie a value belongs to, down to the bits above ``depth``.
    """
    begins = np.flatnonzero(np.concatenate(([True], tops[1:] != tops[:-1])))
    ends = np.append(begins[1:], len(values))
    more = ends - begins > 1
    begins, ends = begins[more], ends[more]
    nothing = np.zeros(len(begins), np.int64)
    stack = [(depth, begins, ends, begins, ends, nothing)]
    while stack:
        depth, lo_a, hi_a, lo_b, hi_b, bits = stack.pop()
        if len(lo_a) > PAIRS:
            half = len(lo_a) // 2
            rest = (lo_a, hi_a, lo_b, hi_b, bits)
            stack.append((depth, *[x[half:] for x in rest]))
            stack.append((depth, *[x[:half] for x in rest]))
            continue
        open_ = ~forest.settled(lo_a, hi_a, lo_b, hi_b)
        lo_a, hi_a, lo_b, hi_b, bits = (x[open_] for x in (lo_a, hi_a, lo_b, hi_b, bits))
        leaf = (hi_a - lo_a == 1) & (hi_b - lo_b == 1)
        if leaf.any():
            a, b = lo_a[leaf], lo_b[leaf]
            near = np.bitwise_count(values[a] ^ values[b]) <= budget
            if near.any():
                forest.link(a[near], b[near])
            lo_a, hi_a, lo_b, hi_b, bits = (x[~leaf] for x in (lo_a, hi_a, lo_b, hi_b, bits))
        if not len(lo_a):
            continue
        mid_a, mid_b = split(values, lo_a, hi_a, depth), split(values, lo_b, hi_b, depth)
        same = lo_a == lo_b
        other = ~same
        children = [
            (lo_a, mid_a, lo_b, mid_b, bits),
            (mid_a, hi_a, mid_b, hi_b, bits),
            (lo_a, mid_a, mid_b, hi_b, bits + 1),
            (mid_a[other], hi_a[other], lo_b[other], mid_b[other], bits[other] + 1),
        ]
        parts = [np.concatenate(x) for x in zip(*children)]
        lo_a, hi_a, lo_b, hi_b, bits = parts
        alone = (lo_a == lo_b) & (hi_a - lo_a == 1)
        keep = (hi_a > lo_a) & (hi_b > lo_b) & (bits <= budget) & ~alone
        if keep.any():
            stack.append((depth + 1, *[x[keep] for x in parts]))


def split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at ``depth`` turns to 1 in each range; above it a range's values are equal."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    edge = (values[lo] & ~(bit | (bit - np.uint64(1)))) | bit
    lo, hi = lo.copy(), hi.copy()
    while True:
        going = lo < hi
        if not going.any():
            return lo
        mid = (lo + hi) >> 1
        below = going & (values[np.minimum(mid, len(values) - 1)] < edge)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(going & ~below, mid, hi)


def near_links(most_bits: int):
    """Rows (trie, fp with the trie's block first, key) of whole blocks to links between keys."""
    widths = [w for _, w in blocks_of(most_bits)]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        tries = rows.column("trie").to_numpy()
        turned = rows.column("turned").to_numpy().view(np.uint64)
        keys = rows.column("key").to_numpy()
        for trie, width in enumerate(widths):
            mine = np.flatnonzero(tries == trie)
            mine = mine[np.argsort(turned[mine], kind="stable")]
            values = turned[mine]
            if len(values) < 2:
                continue
            forest = Forest(len(values))
            tops = values >> np.uint64(BITS - width)
            # What a smaller budget joins needn't be walked again with the whole one.
            for budget in sorted({1, 2, most_bits}):
                if budget <= most_bits:
                    self_join(values, tops, width, budget, forest)
            linked = np.flatnonzero(forest.root != np.arange(len(values)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[mine[linked]]), pa.array(keys[mine[forest.root[linked]]])], ["a", "b"]
                )

    return links


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """Fingerprint and component of each row: ``key`` (a long), ``fingerprint`` (hex), ``component_id``.

    Rows are linked if their fingerprints differ in at most ``most_bits`` bits; a
    component's id is the smallest key in it, itself included. A null or empty text has
    fingerprint zero and is linked like any other; rows with equal fingerprints are in one
    component. A row with a null key has the component of its fingerprint, or null if
    no row with a key has that fingerprint. Repeated rows stay. An empty table gives an empty
    table. Other columns are not read, whatever their names.
    """
    return classified(docs, key, text, words, most_bits).select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """The rows of ``docs`` but for near-duplicates: one row of each component, with all its columns.

    It is the one with the smallest key; of equal keys the one with the smallest text hash,
    and any one of equal rows. Rows with a null key stay only if no row with a key has
    their fingerprint, one for each fingerprint.
    """
    rows = classified(docs, key, text, words, most_bits)
    alone = F.col("component_id").isNull().alias("alone")
    rank = F.struct(F.col("key").isNull().alias("late"), "key", "text_hash")
    first = rows.groupBy(alone, F.coalesce("component_id", "fp").alias("group")).agg(F.min(rank).alias("first"))
    first = first.select(F.col("first.key").alias("_key"), F.col("first.text_hash").alias("_first"))
    marked = docs.withColumn("_hash", text_hash(text))
    same = marked[key].eqNullSafe(first["_key"]) & (marked["_hash"] == first["_first"])
    return marked.join(first, same, "left_semi").dropDuplicates([key, "_hash"]).drop("_hash")


def classified(docs: DataFrame, key: str, text: str, words: int, most_bits: int) -> DataFrame:
    """``key``, ``text_hash``, ``fp`` and ``component_id`` of each row."""
    spark = docs.sparkSession
    prints = staged(fingerprints(docs, key, text, words), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("key").alias("low")), "distinct-fingerprints")
    known = distinct.where("low IS NOT NULL")
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        -(-known.count() * (most_bits + 1) // TASK_ROWS),
    )
    blocks = blocks_of(most_bits)
    turned = F.posexplode(F.array(*[turned_to(F.col("fp"), at) for at, _ in blocks])).alias("trie", "turned")
    turned = known.select(F.col("low").alias("key"), turned)
    top = F.lit(None).cast("long")
    for trie, (_, width) in enumerate(blocks):
        top = F.when(F.col("trie") == trie, F.shiftrightunsigned("turned", BITS - width)).otherwise(top)
    links = turned.repartition(tasks, "trie", top).mapInArrow(near_links(most_bits), "a long, b long")
    roots = components(links)
    classes = distinct.join(roots, distinct["low"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "low").alias("component_id")
    )
    return prints.join(classes, "fp")


def turned_to(fp, first_bit: int):
    """The fingerprint turned so that ``first_bit`` is its highest."""
    if not first_bit:
        return fp
    return F.shiftleft(fp, first_bit).bitwiseOR(F.shiftrightunsigned(fp, BITS - first_bit))
