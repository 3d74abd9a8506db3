"""The distributed trie against one built in plain Python over all texts."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import as_sets
from pyspark.sql import functions as F

from quizloom.llm.common import in_fold
from quizloom.llm.lm_scoring import score_texts
from quizloom.llm.ppm import ESCAPE

ORDER = 3


def learned(doc_id, folds=10):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds != 0


def normal(text):
    return (text or "").encode().lower().split()


class Model:
    """Context counts of all orders in dictionaries; escapes and exclusions one symbol at a time."""

    def __init__(self, texts):
        self.nodes = [defaultdict(Counter) for _ in range(ORDER + 1)]
        for words in texts:
            data = b"\n" * ORDER + b" ".join(words) + b"\n"
            for i in range(ORDER, len(data)):
                for k in range(ORDER + 1):
                    self.nodes[k][data[i - k : i]][data[i]] += 1

    def probability(self, context, symbol):
        result, excluded = 1.0, set()
        for k in range(ORDER, -1, -1):
            node = self.nodes[k].get(context[len(context) - k :])
            if not node:
                excluded = set()
                continue
            left = {s: c for s, c in node.items() if s not in excluded}
            total = sum(left.values())
            if symbol in left:
                return result * (left[symbol] - ESCAPE) / total
            if left:
                result *= len(left) * ESCAPE / total
            excluded = set(node)
        return result / (256 - len(excluded))

    def score(self, words):
        data = b"\n" * ORDER + b" ".join(words) + b"\n"
        return sum(math.log10(self.probability(data[i - ORDER : i], data[i])) for i in range(ORDER, len(data)))


@pytest.fixture(scope="module")
def small(docs):
    # The plain model is slow: without the longest text.
    return docs.where("doc_id IS NULL OR doc_id <> 13")


def expected(rows):
    rows = [(r[0], normal(r[1])) for r in rows if r[0] != 13]
    training = [w for i, w in rows if learned(i)]
    counts = Counter(x for words in training for x in [*words, b"\n"])
    n, v = sum(counts.values()), len(counts)
    model = Model(training)
    found = []
    for doc_id, words in rows:
        tokens = [*words, b"\n"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        found.append((str(doc_id), len(tokens), known, n, base, model.score(words)))
    return sorted(found)


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (300, 500)])
def test_scores_equal_a_plain_model(small, doc_rows, sizes):
    chunk, shard = sizes
    found = score_texts(small, ~in_fold(F.col("doc_id"), 10), order=ORDER, chunk_bytes=chunk, shard_bytes=shard)
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((str(r[0]), *r[1:]) for r in found.select(names).collect())
    want = expected(doc_rows)
    assert len(got) == len(want)
    for one, other in zip(got, want):
        assert one[:4] == other[:4]
        assert one[4:] == pytest.approx(other[4:], rel=1e-6)


def test_no_training_rows_no_rows_and_other_columns(spark, small, no_docs):
    found = score_texts(small, F.lit(False), order=2).where("doc_id = 11").first()
    assert found["n_known"] == 0 and found["train_tokens"] == 0
    assert found["score"] == pytest.approx(2 * math.log10(1 / 256), rel=1e-6)
    assert found["base_score"] == pytest.approx(0.0)
    assert score_texts(no_docs, F.lit(True)).count() == 0
    names = ["doc_id", "n_tokens", "n_known"]
    crowded = small.select("*", F.lit(1).alias("score"), F.lit(1).alias("key"), F.lit(1).alias("chunk"))
    learn = ~in_fold(F.col("doc_id"), 10)
    assert as_sets(score_texts(crowded, learn), names) == as_sets(score_texts(small, learn), names)


def test_probabilities_sum_to_one():
    import numpy as np

    from quizloom.llm.lm_scoring import keys_of
    from quizloom.llm.ppm import Trie, byte_pairs, counted

    grams, counts = counted(keys_of([b"abracadabra\n", b"abc abd\n"], 4))
    trie = Trie(grams, counts, byte_pairs(grams, counts), 4)
    for context in (b"abra", b"xyza", b"\n\n\na", b"qqqq"):
        number = int.from_bytes(context, "big") << 8
        keys = np.uint64(number) | np.arange(256, dtype=np.uint64)
        assert np.exp(trie.log_probabilities(keys)).sum() == pytest.approx(1.0)
