"""Benchmark decontamination by spaced-seed hashing.

A mask samples some token positions of a short span and ignores the others, so two spans
hash alike although tokens at ignored positions differ. Seeds of the benchmark and of the
documents are joined on their hashes; around each hit the two texts are laid side by
side, and an overlap counts if at least ``LEAST_SHARE`` of ``WINDOW`` tokens in a row are
equal. Any such window with two substituted tokens has a seed of the first mask whole;
items of ``FEWEST`` to ``SHORT`` tokens get further masks where these two would miss one, and
items of fewer tokens have one seed, of all their tokens, which only whole texts are held against.

Documents send only seeds that may be in the benchmark: a table of ``FILTER_BITS`` bits,
the same size whatever the benchmark's, has a bit set for each benchmark seed. Hits
that lie close together travel as one row with their stretch of tokens.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, packed, pieces, starts_of, text_hash, unpacked
from quizloom.staging import staged

#: The sampled positions of each mask: five tokens each.
MASKS = ((0, 1, 3, 6, 7), (0, 1, 2, 4, 5))
#: Tokens that an overlap needs, or all tokens of a shorter item; the share that must be equal.
WINDOW = 13
LEAST_SHARE = 0.8
#: Shorter items are in ordinary texts by chance, so a text must be one; items up to ``SHORT`` tokens may need more masks.
FEWEST, SHORT = 4, 12
#: Number of the mask of a whole text of one token; of two tokens the next one, and so on.
WHOLE = 1000
FILTER_BITS = 24
SLICES = 64

TOKEN = re.compile(r"\w+")


class Hashes(dict):
    """Tokens to 64-bit hashes."""

    def __missing__(self, token: str) -> int:
        value = self[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return value


def tokens_of(text: bytes, hashes: Hashes) -> np.ndarray:
    """The hash of each word of a text, in lower case and without punctuation."""
    words = TOKEN.findall(text.decode("utf-8", "replace").lower())
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def seeds_at(tokens: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The hash of the mask laid at each position where it fits."""
    n = len(tokens) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = np.random.default_rng(number).integers(0, 1 << 63, len(mask), np.uint64) | np.uint64(1)
    # Seeds of different masks start apart.
    total = np.full(n, (number + 1) * 0xD6E8FEB86659FD93 % (1 << 64), np.uint64)
    for at, factor in zip(mask, factors):
        total += tokens[at : at + n] * factor
    total ^= total >> np.uint64(32)
    return total * np.uint64(0x9E3779B97F4A7C15)


def whole_seed(tokens: np.ndarray, n: int) -> np.ndarray:
    """The hash of ``n`` tokens in a row at each position, as the seed of a whole text."""
    return seeds_at(tokens, tuple(range(n)), WHOLE + n)


def uncovered(mask: tuple[int, ...], n: int, patterns: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The substituted positions of ``n`` tokens that leave no seed of the mask whole."""
    laid = [{start + at for at in mask} for start in range(n - mask[-1])]
    return [p for p in patterns if not any(seed.isdisjoint(p) for seed in laid)]


def short_masks(
    masks: tuple[tuple[int, ...], ...], window: int, least: float
) -> dict[int, list[tuple[int, ...]]]:
    """For each short length the further masks, so that any allowed substitution leaves a seed whole."""
    more: dict[int, list[tuple[int, ...]]] = {}
    for n in range(FEWEST, min(window, SHORT) + 1):
        equal = max(1, int(np.ceil(least * n - 1e-9)))
        left = list(itertools.combinations(range(n), n - equal))
        for mask in masks:
            left = uncovered(mask, n, left)
        size = min(len(masks[0]), equal)
        tried = [(0, *rest) for rest in itertools.combinations(range(1, n), size - 1)]
        more[n] = []
        while left:
            best = min(tried, key=lambda mask: len(uncovered(mask, n, left)))
            more[n].append(best)
            left = uncovered(best, n, left)
    return more


def bench_seeds(masks: list[tuple[int, ...]], always: int, short: dict[int, list[tuple[int, ...]]]):
    """Items to their seeds: of the first ``always`` masks, and of those for the item's length."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for part, texts in pieces(batches, "text", MB):
            rows: list[list] = [[], [], [], []]
            items = part.column("item").to_pylist()
            for item, text in zip(items, texts):
                tokens = tokens_of(text, hashes)
                if 0 < len(tokens) < FEWEST:
                    rows[0] += whole_seed(tokens, len(tokens)).view(np.int64).tolist()
                    rows[1].append(item)
                    rows[2].append(0)
                    rows[3].append(WHOLE + len(tokens))
                    continue
                mine = short.get(len(tokens), [])
                for number, mask in enumerate(masks):
                    if number >= always and mask not in mine:
                        continue
                    found = seeds_at(tokens, mask, number).view(np.int64).tolist()
                    rows[0] += found
                    rows[1] += [item] * len(found)
                    rows[2] += range(len(found))
                    rows[3] += [number] * len(found)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["seed", "item", "at", "mask"])

    return seeds


def seed_filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """A bit for each possible ``bits``-bit prefix of a seed, put together in slices."""
    width = (1 << bits) // 8 // SLICES

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            mark(table, batch.column("seed").to_numpy().view(np.uint64), bits)
        slices = [packed(x) for x in table.reshape(SLICES, width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(slices)], ["slice", "bits"])

    def joined(rows: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([unpacked(x, np.uint8) for x in rows.column("bits").to_pylist()], axis=0)
        return pa.table([rows.column("slice").slice(0, 1), pa.array([packed(both)])], names=["slice", "bits"])

    schema = "slice int, bits binary"
    found = seeds.select("seed").mapInArrow(marks, schema).groupBy("slice").applyInArrow(joined, schema)
    table = np.zeros((SLICES, width), np.uint8)
    for row in found.collect():
        table[row["slice"]] = unpacked(bytes(row["bits"]), np.uint8)
    return table.ravel()


def mark(table: np.ndarray, seeds: np.ndarray, bits: int) -> None:
    at = (seeds >> np.uint64(64 - bits)).astype(np.int64)
    np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))


def marked(table: np.ndarray, seeds: np.ndarray, bits: int) -> np.ndarray:
    at = (seeds >> np.uint64(64 - bits)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


STRETCH = "text_hash long, first int, tokens binary, seeds array<struct<seed: long, at: int>>"


def stretches(share, masks: list[tuple[int, tuple[int, ...]]], wholes: list[int], bits: int, window: int):
    """Rows to stretches of tokens around seeds that pass the filter.

    Seeds are those of the numbered masks, and of texts of as many tokens as ``wholes`` names.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes = share.value, Hashes()
        for part, texts in pieces(batches, "text", 4 * MB):
            if len(hashes) > 1_000_000:
                hashes.clear()
            tokens = [tokens_of(t, hashes) for t in texts]
            sizes = np.array([len(t) for t in tokens], np.int64)
            flat = np.concatenate([np.empty(0, np.uint64), *tokens])
            owner = np.repeat(np.arange(len(texts)), sizes)
            begins = starts_of(sizes)
            ends = begins + sizes
            at_all, seed_all = [], []
            for number, mask in masks:
                seeds = seeds_at(flat, mask, number)
                at = np.flatnonzero(marked(table, seeds, bits))
                # The span must lie within one text.
                at = at[at + mask[-1] < ends[owner[at]]]
                at_all.append(at)
                seed_all.append(seeds[at])
            for n in wholes:
                at = begins[sizes == n]
                seeds = whole_seed(flat, n)[at]
                passed = marked(table, seeds, bits)
                at_all.append(at[passed])
                seed_all.append(seeds[passed])
            at, seed = np.concatenate(at_all), np.concatenate(seed_all)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order].view(np.int64)
            text = owner[at]
            new = np.ones(len(at), bool)
            new[1:] = (text[1:] != text[:-1]) | (at[1:] - at[:-1] > window)
            cuts = np.append(np.flatnonzero(new), len(at))
            rows: list[list] = [[], [], [], []]
            for a, b in zip(cuts, cuts[1:]):
                one = int(text[a])
                low = max(int(begins[one]), int(at[a]) - window)
                high = min(int(ends[one]), int(at[b - 1]) + 2 * window)
                values = (
                    one,
                    low - int(begins[one]),
                    flat[low:high].tobytes(),
                    [{"seed": s, "at": p} for s, p in zip(seed[a:b].tolist(), (at[a:b] - low).tolist())],
                )
                for column, value in zip(rows, values):
                    column.append(value)
            seeds_type = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(n).take(pa.array(rows[0], pa.int64())) for n in ("key", "text_hash")],
                    pa.array(rows[1], pa.int32()),
                    pa.array(rows[2], pa.binary()),
                    pa.array(rows[3], seeds_type),
                ],
                ["key", "text_hash", "first", "tokens", "seeds"],
            )

    return found


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int, least: float) -> tuple[int, int] | None:
    """First and past-the-last token of ``doc`` in windows that agree with ``item`` laid at ``shift``."""
    low, high = max(0, shift), min(len(doc), shift + len(item))
    size = min(window, len(item))
    if high - low < size:
        return None
    same = np.concatenate(([0], np.cumsum(doc[low:high] == item[low - shift : high - shift])))
    good = np.flatnonzero(same[size:] - same[:-size] >= np.ceil(least * size - 1e-9))
    if not len(good):
        return None
    return low + int(good[0]), low + int(good[-1]) + size


def verifier(window: int, least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            kept, spans = [], []
            texts = batch.column("text").to_pylist()
            doc, first, shift = (batch.column(n).to_pylist() for n in ("tokens", "first", "shift"))
            for i, text in enumerate(texts):
                item = tokens_of(text, hashes)
                found = overlap(np.frombuffer(doc[i], np.uint64), item, shift[i], window, least)
                if found:
                    kept.append(i)
                    spans.append((first[i] + found[0], first[i] + found[1]))
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n).take(rows) for n in ("key", "text_hash", "item")],
                    pa.array([a for a, _ in spans], pa.int32()),
                    pa.array([b for _, b in spans], pa.int32()),
                ],
                ["key", "text_hash", "item", "start", "stop"],
            )

    return verify


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: tuple[tuple[int, ...], ...] = MASKS,
    window: int = WINDOW,
    least: float = LEAST_SHARE,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Overlaps of documents with benchmark items: ``key``, ``text_hash``, ``item``, ``start``, ``stop``.

    Positions count the words of the document's text. An overlap is a run of windows of
    ``window`` words, or of all words of a shorter item, that agree with the item in a share
    of ``least`` or more, word by word. Items of fewer than ``FEWEST`` words are found in the
    documents that hold the same words and no others; null texts and items without words
    overlap nothing; a null item is reported as null.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), text_hash(text).alias("text_hash")
    )
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("binary").alias("text"))
    items = staged(items.where("text IS NOT NULL").withColumn("item_row", F.monotonically_increasing_id()), "items")
    short = short_masks(masks, window, least)
    more = sorted({mask for found in short.values() for mask in found} - set(masks))
    numbered = [*masks, *more]
    seeds = staged(
        items.select(F.col("item_row").alias("item"), "text").mapInArrow(
            bench_seeds(numbered, len(masks), short), "seed long, item long, at int, mask int"
        ),
        "benchmark-seeds",
    )
    # Documents are laid under the masks that some item has.
    used = {r["mask"] for r in seeds.select("mask").distinct().collect()}
    laid = [(number, mask) for number, mask in enumerate(numbered) if number in used or number < len(masks)]
    wholes = [n for n in range(1, FEWEST) if WHOLE + n in used]
    share = docs.sparkSession.sparkContext.broadcast(seed_filter(seeds, bits))
    kind = rows.schema["key"].dataType
    found = staged(
        rows.mapInArrow(
            stretches(share, laid, wholes, bits, window),
            T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(STRETCH).fields]),
        ).withColumn("stretch", F.monotonically_increasing_id()),
        "stretches",
    )
    hits = found.select("stretch", F.inline("seeds")).withColumnRenamed("at", "doc_at")
    candidates = (
        hits.join(seeds, "seed")
        .select("stretch", F.col("item").alias("item_row"), (F.col("doc_at") - F.col("at")).alias("shift"))
        .distinct()
    )
    return (
        candidates.join(found.drop("seeds"), "stretch")
        .join(items, "item_row")
        .select("key", "text_hash", "first", "tokens", "shift", "item", "text")
        .mapInArrow(
            verifier(window, least),
            T.StructType(
                [
                    T.StructField("key", kind),
                    T.StructField("text_hash", T.LongType()),
                    T.StructField("item", items.schema["item"].dataType),
                    *T.StructType.fromDDL("start int, stop int").fields,
                ]
            ),
        )
    )


def overlapping(docs: DataFrame, found: DataFrame, key: str, text: str, how: str) -> DataFrame:
    """``docs`` joined with overlaps by key and text; null keys are equal."""
    mine = docs.withColumn("_hash", text_hash(text))
    same = mine[key].eqNullSafe(found["key"]) & (mine["_hash"] == found["text_hash"])
    joined = mine.join(found, same, how).drop("_hash")
    return joined if how == "left_anti" else joined.drop(found["key"], found["text_hash"])


def contaminated_documents(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **rules
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``contaminated``, ``items`` and ``spans``.

    ``items`` are the distinct items that the document overlaps, ``spans`` the overlaps
    (``start``, ``stop``, ``item``), both sorted; they are empty if there are none. Null keys
    and repeated rows stay; equal rows get equal results. An empty table or benchmark gives
    no overlaps. Other columns are not read. ``rules`` are those of ``find_overlaps``.
    """
    found = find_overlaps(docs, benchmark, key, text, **rules)
    spans = found.groupBy("key", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop", "item"))).alias("spans")
    )
    plain = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    joined = overlapping(plain, spans, "_key", "_text", "left")
    items = F.sort_array(F.array_distinct(F.col("spans.item")))
    return joined.select(
        F.col("_key").alias(key),
        F.col("spans").isNotNull().alias("contaminated"),
        F.coalesce(items, F.array().cast(joined.select(items).schema[0].dataType)).alias("items"),
        F.coalesce("spans", F.array().cast(joined.schema["spans"].dataType)).alias("spans"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **rules
) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns."""
    found = find_overlaps(docs, benchmark, key, text, **rules).select("key", "text_hash").distinct()
    return overlapping(docs, found, key, text, "left_anti")
