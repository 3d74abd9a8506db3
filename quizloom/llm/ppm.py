"""Prediction by partial matching over bytes, on sorted numpy tables.

A gram is ``order`` context bytes and the byte that follows them, packed into one
``uint64`` with the predicted byte lowest. The trie is kept as one sorted table of
grams for each order; a context's node is the run of grams that share it. Orders 1
and 0 come from one 256 x 256 table of counts.

Escape estimation: in a node with ``t`` visits and ``q`` distinct bytes a byte seen ``c``
times has (c - e) / t and the escape e q / t, with ``e`` = ``ESCAPE``. Symbol exclusion: what
a longer context could have predicted is taken out of the shorter one's counts.
Below order 0 all 256 bytes that are left are equally likely. The probabilities of
all bytes after any context sum to 1.
"""

from __future__ import annotations

import numpy as np

#: Ends each text, and stands for what precedes it.
END = 10
#: What every byte of a node gives to the escape. Held-out texts are coded shorter than with 1/2.
ESCAPE = 0.3
#: Orders below this come from the table of byte pairs.
LOWEST = 2


def gram_keys(data: bytes, order: int) -> np.ndarray:
    """The gram that ends at each byte of ``data`` from index ``order`` on; ``order`` is 7 at most."""
    n = len(data) - order
    if n <= 0:
        return np.empty(0, np.uint64)
    # Eight bytes from each position on, the first one highest, cut to the gram.
    windows = np.ndarray((n,), ">u8", data + bytes(8), strides=(1,))
    keys = windows.astype(np.uint64)
    keys >>= np.uint64(8 * (7 - order))
    return keys


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each occurs; ``keys`` is left sorted."""
    keys.sort()
    starts = runs(keys)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of each one's counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = runs(keys)
    if not len(starts):
        return keys, counts
    return keys[starts], np.add.reduceat(counts, starts)


class Places:
    """Finds keys in a sorted table of distinct keys through two hash tables."""

    FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def __init__(self, table: np.ndarray):
        self.table = table
        bits = min(26, max(8, int(len(table)).bit_length() + 2))
        self.shift = np.uint64(64 - bits)
        self.slots = []
        for factor in self.FACTORS:
            slots = np.zeros(1 << bits, np.int32)
            slots[(table * factor) >> self.shift] = np.arange(len(table), dtype=np.int32)
            self.slots.append(slots)

    def values(self, keys: np.ndarray, values: np.ndarray, block: int = 1 << 20) -> np.ndarray:
        """The value of each key; every key must be there."""
        found = np.empty(len(keys), values.dtype)
        for at in range(0, len(keys), block):
            place, _ = self.find(keys[at : at + block])
            found[at : at + block] = values[place]
        return found

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key, and whether the key is there."""
        if not len(self.table):
            return np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
        place = self.slots[0][(keys * self.FACTORS[0]) >> self.shift]
        known = self.table[place] == keys
        left = np.flatnonzero(~known)
        if len(left):
            rest = keys[left]
            at = self.slots[1][(rest * self.FACTORS[1]) >> self.shift]
            good = self.table[at] == rest
            bad = np.flatnonzero(~good)
            if len(bad):
                sorted_at = np.searchsorted(self.table, rest[bad])
                np.minimum(sorted_at, len(self.table) - 1, out=sorted_at)
                at[bad] = sorted_at
                good[bad] = self.table[sorted_at] == rest[bad]
            place[left] = at
            known[left] = good
        return place, known


class Level:
    """The trie's nodes of one order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts.astype(np.float64)
        contexts = grams >> np.uint64(8)
        self.starts = runs(contexts)
        self.nodes = contexts[self.starts]
        self.distinct = np.diff(np.append(self.starts, len(grams))).astype(np.float64)
        self.total = self.sums(self.counts)
        self.gram_places, self.node_places = Places(grams), Places(self.nodes)
        #: What the next shorter context counts for the bytes of this node.
        self.shared = np.zeros(len(self.nodes))

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else np.empty(0)


class Trie:
    """A frozen model: levels ``order`` to ``LOWEST``, and byte pairs below.

    ``grams`` are distinct and sorted, with their training counts above 0. ``pairs``
    counts (last byte, next byte) over the whole corpus. The trie may be a part of a
    larger one, if it holds all grams of each context of ``LOWEST`` bytes it is asked for.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int):
        self.order = order
        self.pairs = pairs.astype(np.float64)
        self.levels: dict[int, Level] = {}
        for k in range(order, LOWEST - 1, -1):
            if k < order:
                grams, counts = merged(grams & mask(k + 1), counts)
            self.levels[k] = Level(grams, counts)
        self.single = self.pairs.sum(axis=0)
        self.pair_total = self.pairs.sum(axis=1)
        self.pair_distinct = (self.pairs > 0).sum(axis=1).astype(np.float64)
        self.pair_shared = (self.pairs > 0) @ self.single
        for k, level in self.levels.items():
            if k > LOWEST:
                below = self.levels[k - 1]
                place, _ = below.gram_places.find(level.grams & mask(k))
                counts_below = below.counts[place] if len(place) else np.empty(0)
            else:
                counts_below = self.pairs.reshape(-1)[(level.grams & mask(2)).astype(np.int64)]
            level.shared = level.sums(counts_below)

    def visits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each of the sorted grams was seen, and the visits of each context among them.

        A gram that was seen ``c`` times in a context of ``t`` visits has probability (c - ESCAPE) / t.
        """
        level = self.levels[self.order]
        contexts = keys >> np.uint64(8)
        contexts = contexts[runs(contexts)]
        if not len(level.grams):
            return np.zeros(len(keys), np.int64), np.zeros(len(contexts), np.int64)
        place, found = level.gram_places.find(keys)
        node, exists = level.node_places.find(contexts)
        counts, totals = np.where(found, level.counts[place], 0), np.where(exists, level.total[node], 0)
        return counts.astype(np.int64), totals.astype(np.int64)

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """The natural log of the probability of each gram's last byte after its context."""
        result = np.zeros(len(keys))
        open_ = np.arange(len(keys))
        # Bytes and counts that the next longer context has taken out.
        gone, out = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(self.order, -2, -1):
            if not len(open_):
                break
            rest = keys[open_]
            byte = (rest & np.uint64(255)).astype(np.int64)
            if k >= LOWEST:
                level = self.levels[k]
                node, exists = level.node_places.find((rest >> np.uint64(8)) & mask(k))
                place, found = level.gram_places.find(rest & mask(k + 1))
                if len(level.nodes):
                    total, distinct = level.total[node], level.distinct[node]
                    shared, count = level.shared[node], level.counts[place]
                else:
                    total = distinct = shared = count = np.zeros(len(rest))
            elif k == 1:
                last = ((rest >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
                total, distinct = self.pair_total[last], self.pair_distinct[last]
                shared, count = self.pair_shared[last], self.pairs[last, byte]
                exists, found = total > 0, count > 0
            elif k == 0:
                all_, seen = self.single.sum(), float((self.single > 0).sum())
                total, distinct = np.full(len(rest), all_), np.full(len(rest), seen)
                shared, count = np.zeros(len(rest)), self.single[byte]
                exists, found = total > 0, count > 0
            else:
                result[open_] -= np.log(256.0 - gone)
                break
            t = np.where(exists, total - out, 1.0)
            q = np.where(exists, distinct - gone, 0.0)
            hit = found & exists
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.log(np.where(hit, count - ESCAPE, q * ESCAPE) / t)
            # A node whose bytes are all taken out is left with certainty.
            result[open_] += np.where(hit | (q > 0), step, 0.0)
            # A context that was never seen takes nothing out of the next one.
            gone, out = np.where(exists, distinct, 0.0), np.where(exists, shared, 0.0)
            open_, gone, out = open_[~hit], gone[~hit], out[~hit]
        return result


def mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


def byte_pairs(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 256 x 256 counts of the last two bytes of each gram."""
    cells = (grams & mask(2)).astype(np.int64)
    return np.bincount(cells, weights=counts, minlength=65536).reshape(256, 256)
