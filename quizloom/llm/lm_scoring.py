"""Scores texts by prediction by partial matching, with a trie of the whole corpus.

The trie of a large corpus fits in no task. Each text goes into a chunk of a few
megabytes. A chunk sends the distinct byte grams and words that it holds, packed, to
the shards that own them; a shard merges the counts of all chunks, builds its part of
the trie and sends each chunk the log-probabilities of the grams it asked for. A
gram's shard comes from the last two bytes of its context, so a shard has every node
on the way from a gram's longest context to its shortest; only the table of byte
pairs, 65,536 cells, is needed everywhere.

Nothing is gathered per text or per corpus: a task holds one chunk, or the distinct
grams and words of one shard.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import (
    MB,
    packed,
    packed_ints,
    packed_sorted,
    parts_for,
    pieces,
    run_sums,
    starts_of,
    text_bytes,
    unpacked,
    unpacked_ints,
    unpacked_sorted,
)
from quizloom.llm.ppm import END, ESCAPE, Places, Trie, byte_pairs, counted, gram_keys, merged, runs
from quizloom.staging import staged

ORDER = 5
CHUNK = 6 * MB
#: Bytes of text for each shard, and the most shards: more would leave too few grams in a packed row.
SHARD = 8 * MB
MOST_SHARDS = 4096

#: What a chunk asks of a shard; ``shard`` is -1 in the row that holds the chunk's texts.
REQUEST = "chunk string, shard int, grams binary, counts binary, words binary, word_counts binary"
ASKED = ("chunk", "shard", "grams", "counts", "words", "word_counts")
#: ``chunk`` is null in the row that holds the number of distinct words of a shard.
ANSWER = "chunk string, shard int, counts binary, totals binary, escaped binary, known binary, vocabulary long"
ANSWERED = ("counts", "totals", "escaped", "known")


def keys_of(texts: list[bytes], order: int) -> np.ndarray:
    """The gram of each byte of each text, one after another; what precedes a text is ``END``."""
    pad = bytes([END]) * order
    sizes = np.array([len(x) for x in texts], np.int64)
    keys = gram_keys(pad.join([b"", *texts]), order)
    keep = np.ones(len(keys), bool)
    begins = starts_of(sizes + order)[1:]
    for j in range(order):
        keep[begins - order + j] = False
    return keys[keep]


def shards_of_grams(keys: np.ndarray, shards: int) -> np.ndarray:
    context = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    return (((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)


def score_texts(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    chunk_bytes: int = CHUNK,
    shard_bytes: int = SHARD,
) -> DataFrame:
    """The log-probability of each text: one row for each row of ``docs``.

    Columns: ``key``, ``n_tokens`` (words and the end), ``n_known`` (tokens seen in
    training), ``train_tokens``, ``base_score`` (log10, words by their counts plus 0.1)
    and ``score`` (log10 of the text by the trie: lower-cased words with one space
    between, then an end). Both learn from the rows for which ``learn`` is true.

    A null text is an empty one, and an empty text is its end alone. Null keys are
    scored too. Equal rows are scored each and each count in training. Without training
    rows each byte has probability 1/256. An empty table gives an empty table. Columns
    other than ``key`` and ``text`` are not read, whatever their names.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("binary").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    key_type = rows.schema["key"].dataType
    shards = parts_for(text_bytes(rows, "text"), shard_bytes, MOST_SHARDS)
    requests = staged(
        rows.mapInArrow(
            chunker(order, shards, chunk_bytes),
            f"{REQUEST}, keys array<{key_type.simpleString()}>, sizes binary, texts binary, "
            "tokens long, learned long, pairs binary",
        ),
        "lm-requests",
    )
    chunks, asked = requests.where("shard < 0"), requests.where("shard >= 0")
    train_tokens, learned = (
        x or 0 for x in chunks.agg(F.sum("tokens"), F.sum("learned")).first()
    )
    phases = asked.select(*ASKED, F.explode(F.array(F.lit(0), F.lit(1))).alias("phase"))
    for name in ("counts", "word_counts"):
        phases = phases.withColumn(name, F.when(F.col("phase") == 0, F.col(name)))
    answers = staged(
        # The counts of all chunks come before the first chunk to be answered.
        phases.repartition(shards, "shard")
        .sortWithinPartitions("shard", "phase")
        .mapInArrow(answerer(pair_counts(chunks), order), ANSWER),
        "lm-answers",
    )
    vocabulary = answers.agg(F.sum("vocabulary")).first()[0] or 0
    scored = (
        chunks.select("chunk", "keys", "sizes", "texts")
        .groupBy("chunk")
        .cogroup(answers.where("chunk IS NOT NULL").drop("vocabulary").groupBy("chunk"))
        .applyInArrow(
            scorer(key, order, shards, train_tokens, vocabulary, learned),
            T.StructType(
                [
                    T.StructField(key, key_type),
                    *T.StructType.fromDDL(
                        "n_tokens long, n_known long, base_score double, score double"
                    ).fields,
                ]
            ),
        )
    )
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("long"))


SCORES = ("n_tokens", "n_known", "base_score", "score")


def chunker(order: int, shards: int, chunk_bytes: int):
    """Rows to chunks: a row with the texts, and a row for each shard that owns something of it.

    The texts to learn from come first, so the words in the order of their first
    appearance are those seen in training, then the others.
    """

    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in pieces(batches, "text", chunk_bytes):
            chunk = uuid.uuid4().hex
            learn = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            turn = np.argsort(~learn, kind="stable")
            learned = int(learn.sum())
            texts = [b" ".join(raw[i].lower().split()) + bytes([END]) for i in turn.tolist()]
            raw.clear()
            trained = Counter(b"".join(texts[:learned]).split())
            others = dict.fromkeys(b"".join(texts[learned:]).split())
            words = [*trained, *(w for w in others if w not in trained)]
            grams, counts = counted(keys_of(texts[:learned], order))
            more, _ = counted(keys_of(texts[learned:], order))
            grams, counts = merged(
                np.concatenate((grams, more)), np.concatenate((counts, np.zeros(len(more), np.int64)))
            )
            keys = part.column("key").take(pa.array(turn))
            yield request_row(
                keys,
                chunk=chunk,
                shard=-1,
                sizes=packed(np.array([len(t) for t in texts], np.int64)),
                texts=zstandard.compress(b"".join(texts), 1),
                tokens=sum(trained.values()) + learned,
                learned=learned,
                pairs=packed(byte_pairs(grams, counts).astype(np.int64)),
            )
            owner = shards_of_grams(grams, shards)
            at = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[at], np.arange(shards + 1))
            for shard, mine in enumerate(by_shard(words, shards)):
                here = at[ends[shard] : ends[shard + 1]]
                if len(here) or mine:
                    yield request_row(
                        keys.slice(0, 0),
                        chunk=chunk,
                        shard=shard,
                        grams=packed_sorted(grams[here]),
                        counts=packed_ints(counts[here]),
                        words=zstandard.compress(b"\n".join(mine), 1),
                        word_counts=packed_ints(np.array([trained[w] for w in mine], np.int64)),
                    )

    return chunk_rows


def request_row(keys: pa.Array, **values) -> pa.RecordBatch:
    kinds = {"chunk": pa.string(), "shard": pa.int32(), "tokens": pa.int64(), "learned": pa.int64()}
    names = [*ASKED, "keys", "sizes", "texts", "tokens", "learned", "pairs"]
    columns = [
        pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        if name == "keys"
        else pa.array([values.get(name)], kinds.get(name, pa.binary()))
        for name in names
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def by_shard(words: list[bytes], shards: int) -> list[list[bytes]]:
    """The words of each shard, in the order given."""
    split: list[list[bytes]] = [[] for _ in range(shards)]
    for word in words:
        split[zlib.crc32(word) % shards].append(word)
    return split


def split_words(data: bytes) -> list[bytes]:
    joined = zstandard.decompress(data)
    return joined.split(b"\n") if joined else []


def pair_counts(chunks: DataFrame) -> np.ndarray:
    """How often each byte follows each byte in training: 65,536 cells."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, np.int64)
        for batch in batches:
            for data in batch.column("pairs").to_pylist():
                total += unpacked(data, np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], ["cell", "n"]
        )

    cells = (
        chunks.select("pairs")
        .mapInArrow(summed, "cell int, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
    )
    pairs = np.zeros(65536, np.int64)
    for cell, n in cells.collect():
        pairs[cell] = n
    return pairs.reshape(256, 256)


class Shard:
    """Counts of one shard, merged as they come."""

    def __init__(self):
        self.grams, self.counts = [], []
        self.held, self.distinct = 0, 0
        self.words: dict[bytes, int] = {}

    def add(self, grams: np.ndarray, counts: np.ndarray, words: list[bytes], word_counts) -> None:
        seen = counts > 0
        self.grams.append(grams[seen])
        self.counts.append(counts[seen])
        self.held += int(seen.sum())
        if self.held > 2 * self.distinct + (1 << 20):
            self.merge()
        mine = self.words
        for word, n in zip(words, word_counts.tolist()):
            if n:
                mine[word] = mine.get(word, 0) + n

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([np.empty(0, np.uint64), *self.grams])
        counts = np.concatenate([np.empty(0, np.int64), *self.counts])
        grams, counts = merged(grams, counts)
        self.grams, self.counts = [grams], [counts]
        self.held = self.distinct = len(grams)
        return grams, counts


def answerer(pairs: np.ndarray, order: int):
    """Sorted rows of a shard, counts first, to answers for its chunks."""
    kinds = [pa.string(), pa.int32(), *[pa.binary()] * 4, pa.int64()]
    names = ["chunk", "shard", *ANSWERED, "vocabulary"]

    def row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, trie = None, Shard(), None
        for batch in batches:
            for at in range(batch.num_rows):
                asked = {n: batch.column(n)[at].as_py() for n in (*ASKED, "phase")}
                if asked["shard"] != current:
                    current, state, trie = asked["shard"], Shard(), None
                grams, words = unpacked_sorted(asked["grams"]), split_words(asked["words"])
                if asked["phase"] == 0:
                    counts = unpacked_ints(asked["counts"])
                    state.add(grams, counts, words, unpacked_ints(asked["word_counts"]))
                    continue
                if trie is None:
                    trie = Trie(*state.merge(), pairs, order)
                    state.grams, state.counts = [], []
                    yield row(None, current, None, None, None, None, len(state.words))
                counts, totals = trie.visits(grams)
                escaped = trie.log_probabilities(grams[counts == 0])
                found = state.words.get
                known = np.array([found(w, 0) for w in words], np.int64)
                parts = packed_ints(counts), packed_ints(totals), packed(escaped), packed_ints(known)
                yield row(asked["chunk"], current, *parts, None)

    return answers


def log10_of(grams: np.ndarray, answer: dict) -> np.ndarray:
    """The log10 probability of each gram that a shard was asked for."""
    counts = unpacked_ints(answer["counts"])
    starts = runs(grams >> np.uint64(8))
    totals = np.repeat(unpacked_ints(answer["totals"]), np.diff(np.append(starts, len(grams))))
    logs = np.empty(len(grams))
    seen = counts > 0
    logs[seen] = np.log((counts[seen] - ESCAPE) / totals[seen])
    logs[~seen] = unpacked(answer["escaped"], np.float64)
    return logs / math.log(10)


def scorer(key: str, order: int, shards: int, train_tokens: int, vocabulary: int, learned: int):
    """A chunk's texts and its answers to scores. Each of the ``learned`` texts had an end."""
    floor = math.log10(train_tokens + 0.1 * (vocabulary + (learned > 0) + 1))

    def scores(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys, sizes, joined = (texts.column(n)[0] for n in ("keys", "sizes", "texts"))
        sizes = unpacked(sizes.as_py(), np.int64)
        joined = zstandard.decompress(joined.as_py())
        rows = {r["shard"]: r for r in answers.select(["shard", *ANSWERED]).to_pylist()}
        words = joined.split()
        number = dict.fromkeys(words)
        seen: dict[bytes, int] = {}
        for shard, mine in enumerate(by_shard(list(number), shards)):
            if mine:
                seen.update(zip(mine, unpacked_ints(rows[shard]["known"]).tolist()))
        counts = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        del words, number, seen
        # Words end at a blank or, the last of a text, at its end.
        data = np.frombuffer(joined, np.uint8)
        begins = starts_of(sizes)
        lone = sizes == 1
        in_text = np.add.reduceat(data == ord(" "), begins, dtype=np.int64) + ~lone
        base = run_sums(np.log10(counts + 0.1), in_text) + math.log10(learned + 0.1)
        known = run_sums(counts > 0, in_text).astype(np.int64) + (learned > 0)
        texts_ = [joined[a : a + n] for a, n in zip(begins.tolist(), sizes.tolist())]
        grams_at = keys_of(texts_, order)
        grams, _ = counted(grams_at.copy())
        owner = shards_of_grams(grams, shards)
        logs = np.zeros(len(grams))
        for shard, answer in rows.items():
            mine = np.flatnonzero(owner == shard)
            logs[mine] = log10_of(grams[mine], answer)
        logs_at = Places(grams).values(grams_at, logs)
        score = np.add.reduceat(logs_at, begins, dtype=np.float64)
        columns = [keys.values, in_text + 1, known, base - (in_text + 1) * floor, score]
        return pa.table([pa.array(c) for c in columns], names=[key, *SCORES])

    return scores
