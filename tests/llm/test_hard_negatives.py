"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizloom.llm import hard_negatives as mining
from quizloom.llm.hard_negatives import hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (33, 64, 65), (100, 70, 41), (0, 4, 3), (5, 0, 5)])
@pytest.mark.parametrize("leaf", [1, 2, 8])
def test_product_is_exact(shape, leaf):
    m, k, n = shape
    random_ = np.random.default_rng(sum(shape))
    a, b = random_.integers(-(1 << 28), 1 << 28, (m, k)), random_.integers(-(1 << 28), 1 << 28, (k, n))
    assert (strassen(a, b, leaf) == a @ b).all()


def rows(n=400, dim=9, seed=3):
    random_ = random.Random(seed)
    centres = [[random_.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    found = []
    for i in range(n):
        centre = centres[random_.randrange(4)]
        vector = [round(c + random_.gauss(0, 0.7), 1) for c in centre]
        found.append((i, vector, random_.randrange(4)))
    found += [(i + 3, found[i][1], found[i][2]) for i in range(50, 90)]  # ties and repeated keys
    found += [(50, [1.0] * dim, 1), (50, [1.0] * dim, 1), (51, [1.0] * dim, 2)]
    found += [(1000, None, 1), (1050, [1.0], 1), (1051, [2.0], 1), (1052, [1.5], 2), (1100, [], 1), (1101, [], 2), (1102, [], 1)]
    found += [(1150, [None] + [1.0] * (dim - 1), 1), (1200, [NAN] * dim, 1), (1250, [INF] * dim, 1), (1300, [1.0] * dim, None)]
    found += [(1350, [1e30] * dim, 1), (None, [1.0] * dim, 1), (1400, [0.0] * dim, 1), (1401, [-0.01] * dim, 2)]
    return found


def plain(known):
    good = []
    for i, e, label in known:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) or abs(x) > 1e5 for x in e):
            continue
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in e], label))
    for a, (i, e, label) in enumerate(good):
        if i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(e, f)), j, b, m) for b, (j, f, m) in enumerate(good) if len(f) == len(e)]
        scored.sort()
        positives = [s for s in scored if s[3] == label and s[2] != a][:5]
        for p in positives:
            window = [s for s in scored if s[3] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            for rank, s in enumerate(window, 1):
                yield i, p[1], rank, s[1], -p[0], -s[0]


def mined(frame, **options):
    found = hard_negatives(frame, anchor=F.col("vec_id") % 50 == 0, **options)
    return sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_equals_all_pairs(spark):
    # Repeated keys of equal score come in the order of the table: one partition keeps it.
    known = rows()
    assert mined(spark.createDataFrame(known, SCHEMA).coalesce(1)) == sorted(plain(known))


def test_many_tiles_give_the_same(spark, monkeypatch):
    frame = spark.createDataFrame(rows(), SCHEMA).coalesce(1).cache()
    want = mined(frame)
    monkeypatch.setattr(mining, "ANCHORS", 1)
    monkeypatch.setattr(mining, "CANDIDATES", 2)
    assert mined(frame) == want


def test_all_vectors_equal(spark):
    known = [(i, [0.5, 0.25], i % 2) for i in range(700)] + [(i, [0.4, 0.2], i % 2) for i in range(700, 900)]
    assert mined(spark.createDataFrame(known, SCHEMA)) == sorted(plain(known))


def test_further_columns_and_no_rows(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).coalesce(1)
    crowded = frame.select("*", *[F.lit("other").alias(n) for n in ("id", "row", "score", "rank", "size", "block", "owner", "scores", "_row")])
    assert mined(crowded) == mined(frame)
    assert mined(frame.limit(0)) == []
