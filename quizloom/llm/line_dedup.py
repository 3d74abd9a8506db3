"""Line dedup by pairwise alignment.

Two documents overlap if they share a run of lines with ``LEAST_WORDS`` words or more. A
run's key is the hash of the fewest lines from some line on that have that many words:
rare enough to be no accident, and every common block of that size has one at its start.
The first holder of a key is its earliest document, and every later one is paired with
it: as many pairs as there are shared keys at most, also for a passage that most
documents have, and no pair of two later ones.

A pair is aligned by patience diff: lines that occur once in either document, the longest
chain of them in the order of both, then the same for what is left (repeated and moved
lines). Aligned lines that follow one another in both documents are a block, and blocks of
``LEAST_WORDS`` words or more are deleted from the later document. What is deleted is in an
earlier document, and the earliest holder of it keeps it.

Documents with equal texts are one: the earliest stands for them and the later ones are
deleted whole. Only hashes and positions travel until the texts are rewritten.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, pieces, text_hash
from quizloom.staging import staged

LEAST_WORDS = 10

SIGNATURE = (
    "text_hash long, doc binary, lines array<struct<line: long, at: array<int>>>, words binary, runs array<long>"
)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def runs_of(hashes: list[int], words: list[int], least: int) -> list[int]:
    """The distinct keys of a text: from each line with words on, the fewest lines with ``least`` words."""
    keys, stop, held = set(), 0, 0
    for start, n in enumerate(words):
        while held < least and stop < len(words):
            held += words[stop]
            stop += 1
        if held < least:
            break
        if n:
            run = np.array([h for h, w in zip(hashes[start:stop], words[start:stop]) if w], np.int64)
            keys.add(signed(xxhash.xxh64_intdigest(run.tobytes())))
        held -= n
    return sorted(keys)


def signer(least: int):
    """Rows to the hashes of their text, lines and runs."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for part, texts in pieces(batches, "text", 4 * MB):
            rows: list[list] = [[], [], [], []]
            for text in texts:
                lines = text.split(b"\n")
                hashes = [signed(digest(line)) for line in lines]
                words = [len(line.split()) for line in lines]
                places: dict[int, list[int]] = {}
                for at, line in enumerate(hashes):
                    places.setdefault(line, []).append(at)
                rows[0].append(xxhash.xxh3_128_digest(text))
                rows[1].append([{"line": line, "at": at} for line, at in places.items()])
                rows[2].append(np.minimum(words, 1 << 30).astype(np.int32).tobytes())
                rows[3].append(runs_of(hashes, words, least))
            line = pa.struct([("line", pa.int64()), ("at", pa.list_(pa.int32()))])
            kinds = (pa.binary(), pa.list_(line), pa.binary(), pa.list_(pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("text_hash"), *arrays],
                ["key", "text_hash", "doc", "lines", "words", "runs"],
            )

    return signatures


def chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, sorted by the first place, that rises in the second too (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[pile], piles[pile] = b, i
    found, i = [], piles[-1] if piles else -1
    while i >= 0:
        found.append(pairs[i])
        i = before[i]
    return found[::-1]


def aligned(shared: list[tuple[list[int], list[int]]], of_later: list[int], of_earlier: list[int]) -> dict[int, int]:
    """Places in the later document to places in the earlier one, from the places of each shared line.

    ``of_later`` and ``of_earlier`` name the shared line at each place, negative if there is none.
    First the longest chain of lines that are unique in both, with the equal lines beside
    them, then the other unique lines, which have moved; then the same for repeated lines,
    taken in the order they occur.
    """
    match: dict[int, int] = {}
    taken: set[int] = set()
    unique = [len(as_) == len(bs) == 1 for as_, bs in shared]

    def take(pairs: list[tuple[int, int]]) -> None:
        fresh = [p for p in pairs if p[0] not in match and p[1] not in taken]
        match.update(fresh)
        taken.update(b for _, b in fresh)
        for step in (1, -1):
            for a, _ in fresh:
                b = match[a]
                while True:
                    a, b = a + step, b + step
                    if not (0 <= a < len(of_later) and 0 <= b < len(of_earlier)):
                        break
                    line = of_later[a]
                    if line != of_earlier[b] or line < 0 or unique[line] or a in match or b in taken:
                        break
                    match[a] = b
                    taken.add(b)

    once = sorted((as_[0], bs[0]) for (as_, bs), one in zip(shared, unique) if one)
    take(chain(once))
    take(once)
    left = [
        p
        for as_, bs in shared
        for p in zip([x for x in as_ if x not in match], [x for x in bs if x not in taken])
    ]
    take(chain(sorted(left)))
    take(left)
    return match


def blocks_of(match: dict[int, int], words: np.ndarray, least: int) -> list[range]:
    """Places that are neighbours in both documents, in blocks of ``least`` words or more."""
    if not match:
        return []
    places = np.array(sorted(match))
    others = np.array([match[a] for a in places.tolist()])
    ends = np.flatnonzero((np.diff(places) != 1) | (np.diff(others) != 1)) + 1
    firsts = places[np.concatenate(([0], ends))]
    lasts = places[np.concatenate((ends, [len(places)])) - 1]
    before = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    return [range(a, b + 1) for a, b in zip(firsts.tolist(), lasts.tolist()) if before[b + 1] - before[a] >= least]


class Windows:
    """Finds where a run of a text's lines occurs again, by hashes of all runs of its length."""

    def __init__(self, lines: np.ndarray, places: list[np.ndarray]):
        self.lines, self.places = lines, places
        # Sums of values times powers of an odd number, modulo 2^64; a run's is moved to the first power.
        random_ = np.random.default_rng(5).integers(0, 1 << 63, len(places) + 1, np.uint64)
        base = 0x9E3779B97F4A7C15
        powers = np.full(len(lines) + 1, base, np.uint64)
        back = np.full(len(lines) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[0] = back[0] = 1
        self.back = np.cumprod(back)
        values = random_[lines] * np.cumprod(powers)[:-1]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))

    def repeats(self, block: range) -> np.ndarray:
        """The places where the lines of ``block`` begin, itself included; tried where its rarest line is."""
        wanted = self.lines[block.start : block.stop]
        rarest = int(np.argmin([len(self.places[n]) for n in wanted.tolist()]))
        starts = self.places[wanted[rarest]] - rarest
        starts = starts[(starts >= 0) & (starts + len(block) <= len(self.lines))]
        hashes = (self.sums[starts + len(block)] - self.sums[starts]) * self.back[starts]
        own = (self.sums[[block.stop]] - self.sums[[block.start]]) * self.back[[block.start]]
        return starts[hashes == own]


def common_places(shared: list[tuple[list[int], list[int]]], words: np.ndarray, least: int) -> list[int]:
    """All places of the later document to delete.

    A block goes wherever the later document repeats it. What is left is aligned with the
    whole earlier document again, until no block is found. Memory grows with the lines of
    both, however often a line repeats.
    """
    line_at = np.full(len(words), -1)
    of_earlier = [-2] * (1 + max(b for _, bs in shared for b in bs))
    for line, (as_, bs) in enumerate(shared):
        line_at[as_] = line
        for b in bs:
            of_earlier[b] = line
    windows = Windows(line_at, [np.array(as_) for as_, _ in shared])
    gone = np.zeros(len(words), bool)
    while True:
        before = gone.copy()
        rest = [([a for a in as_ if not before[a]], bs) for as_, bs in shared]
        of_later = np.where(before, -1, line_at).tolist()
        blocks = blocks_of(aligned(rest, of_later, of_earlier), words, least)
        if not blocks:
            return np.flatnonzero(gone).tolist()
        seen = set()
        for block in blocks:
            gone[block.start : block.stop] = True
            lines = line_at[block.start : block.stop]
            if lines.tobytes() in seen:
                continue
            seen.add(lines.tobytes())
            starts = windows.repeats(block)
            starts = starts[~before[starts]]
            i = 0
            while i < len(starts):
                start = int(starts[i])
                stop = start + len(block)
                if (line_at[start:stop] == lines).all():
                    if not gone[start:stop].any():
                        gone[start:stop] = True
                    i = int(np.searchsorted(starts, stop))
                else:
                    i += 1


def aligner(least: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places = [], []
            for i in range(batch.num_rows):
                # One pair at a time: a batch may hold many long documents.
                doc, words, shared = (batch.column(n)[i].as_py() for n in ("doc", "words", "shared"))
                found = common_places(
                    [(s["later_at"], s["at"]) for s in shared], np.frombuffer(words, np.int32), least
                )
                if found:
                    docs.append(doc)
                    places.append(found)
            kinds = (pa.binary(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((docs, places), kinds)], ["doc", "places"])

    return align


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``n_lines``, ``n_deleted`` and ``copy`` added.

    The earlier of two documents is that with the smaller key, null keys last; among equal
    keys the order is fixed but arbitrary. Rows with equal key and text are one document:
    what is decided holds for all of them. A later document with the text of an earlier one
    is a ``copy``: all its lines go and its text becomes empty. A null or empty text has no
    lines and stays as it is, and is no copy. Other columns stay; ``n_lines``, ``n_deleted``
    and ``copy`` replace columns of these names. An empty table stays empty.
    """
    columns = [n for n in docs.columns if n not in ("n_lines", "n_deleted", "copy")]
    rows = docs.where(F.octet_length(F.col(text).cast("binary")) > 0).select(
        F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), text_hash(text).alias("text_hash")
    )
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL(SIGNATURE).fields])
    signatures = staged(rows.mapInArrow(signer(least), schema), "line-signatures")
    # The first of equal texts stands for all; a null key comes last.
    rank = F.struct(F.col("key").isNull().alias("late"), "key", "doc")
    originals = staged(
        signatures.groupBy("doc")
        .agg(F.min(rank).alias("rank"), F.min_by(F.struct("lines", "words", "runs"), rank).alias("of"))
        .select("doc", "rank", "of.*"),
        "originals",
    )
    keys = originals.select("rank", F.explode("runs").alias("run"))
    holders = keys.groupBy("run").agg(F.min("rank").alias("holder"), F.count(F.lit(1)).alias("holders"))
    pairs = (
        keys.join(holders.where("holders > 1").select("run", "holder"), "run")
        .where(F.col("rank.doc") != F.col("holder.doc"))
        .select(F.col("rank.doc").alias("doc"), F.col("holder.doc").alias("earlier"))
        .distinct()
    )
    lines = originals.select("doc", F.inline("lines"))
    later = pairs.join(lines.withColumnRenamed("at", "later_at"), "doc")
    shared = (
        later.join(lines.withColumnRenamed("doc", "earlier"), ["earlier", "line"])
        .groupBy("doc", "earlier")
        .agg(F.collect_list(F.struct("later_at", "at")).alias("shared"))
    )
    deleted = (
        shared.join(originals.select("doc", "words"), "doc")
        .select("doc", "words", "shared")
        .mapInArrow(aligner(least), "doc binary, places array<int>")
        .groupBy("doc")
        .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    )
    # A table of its own: joined with it alone, the rows of a much copied text can be split among tasks.
    by_doc = staged(
        originals.select("doc", F.col("rank.key").alias("first")).join(deleted, "doc", "left"),
        "line-verdicts",
    )
    verdicts = (
        signatures.select("key", "text_hash", "doc")
        .distinct()
        .join(by_doc, "doc")
        .withColumn("copy", ~F.col("key").eqNullSafe(F.col("first")))
        .where("copy OR places IS NOT NULL")
        .select(F.col("key").alias("_key"), "text_hash", F.col("copy").alias("_copy"), F.col("places").alias("_places"))
    )
    marked = docs.select(*columns).withColumn("_hash", text_hash(text))
    same = marked[key].eqNullSafe(verdicts["_key"]) & (marked["_hash"] == verdicts["text_hash"])
    joined = marked.join(verdicts, same, "left").select(*columns, "_copy", "_places")
    added = T.StructType.fromDDL("n_lines long, n_deleted long, copy boolean").fields
    return joined.mapInArrow(
        rewriter(columns, text), T.StructType([*[docs.schema[n] for n in columns], *added])
    )


def rewriter(columns: list[str], text: str):
    """Rows with their verdicts to rows with the lines that stay."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            n_lines = [t.count("\n") + 1 if t else 0 for t in texts]
            n_deleted = [0] * len(texts)
            copies = [bool(c) for c in batch.column("_copy").to_pylist()]
            for i, places in enumerate(batch.column("_places").to_pylist()):
                if copies[i]:
                    texts[i], n_deleted[i] = "", n_lines[i]
                elif places:
                    gone = set(places)
                    lines = texts[i].split("\n")
                    texts[i] = "\n".join(x for at, x in enumerate(lines) if at not in gone)
                    n_deleted[i] = len(gone)
            values = {n: batch.column(n) for n in columns}
            values[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    *values.values(),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_deleted, pa.int64()),
                    pa.array(copies, pa.bool_()),
                ],
                [*columns, "n_lines", "n_deleted", "copy"],
            )

    return rewrite
