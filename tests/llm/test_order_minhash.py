"""Order MinHash against a plain version that orders all elements for each sketch."""

import hashlib
import random
import re

import pytest
import xxhash
from conftest_llm import WORDS, as_sets, prose
from pyspark.sql import functions as F

from quizloom.llm.order_minhash import KMER, LENGTH, LONGEST, SKETCHES, fingerprint_edits, likeness, with_fingerprint

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def chain(parts, seed=42):
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed


def long_(x):
    return x.to_bytes(8, "little")


def plain(text):
    tokens = [chain([t.encode()]) for t in re.findall(rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}", text or "")]
    places = range(max(len(tokens) - KMER + 1, 1) if tokens else 0)
    seen, points = {}, []
    for i in places:
        kmer = [long_(t) for t in tokens[i : i + KMER]]
        n = seen[tuple(kmer)] = seen.get(tuple(kmer), -1) + 1
        points.append((chain(kmer + ([n.to_bytes(4, "little")] if n else [])) >> 1, i, chain(kmer)))
    found = []
    for j in range(SKETCHES):
        start = j * (1 << 63) // SKETCHES
        minimal = sorted(points, key=lambda p: (p[0] - start) % (1 << 63))[:LENGTH]
        found.append(chain([long_(p[2]) for p in sorted(minimal, key=lambda p: p[1])]) >> 32)
    return "".join(f"{x:08x}" for x in found)


def edited(rows):
    """Key, text and edited text in the operator's order."""
    known = [(k, t or "") for k, t in rows]
    known.sort(key=lambda r: (r[0] is None, r[0] or 0, int.from_bytes(long_(chain([r[1].encode()])), "little", signed=True)))
    for i, (k, t) in enumerate(known):
        quarter = len(t) // 4
        after = known[(i + 1) % len(known)][1]
        yield k, t, t[: len(t) - quarter] + after[:quarter], after


def share(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / SKETCHES


def test_equals_plain_version(docs, doc_rows):
    want = []
    for k, t, e, after in edited([(r[0], r[1]) for r in doc_rows]):
        own, other = plain(t), plain(e)
        sha = hashlib.sha256(e.encode()).hexdigest()
        want.append(repr((k, len(t), sha, own, other, share(own, other), share(own, plain(after)))))
    assert as_sets(fingerprint_edits(docs), COLUMNS) == sorted(want)


def test_further_columns_and_no_rows(docs, crowded, no_docs):
    assert as_sets(fingerprint_edits(crowded), COLUMNS) == as_sets(fingerprint_edits(docs), COLUMNS)
    assert fingerprint_edits(no_docs).collect() == []


def test_one_row_follows_itself(spark, no_docs):
    one = spark.createDataFrame([(5, "a b c d e f g h", None, None, None)], no_docs.schema)
    row = fingerprint_edits(one).first()
    assert row["near_next"] == 1.0 and row["fingerprint"] == plain("a b c d e f g h")
    assert row["edited_fingerprint"] == plain("a b c d e f " + "a b")


def test_order_and_repeats_matter(spark):
    random_ = random.Random(4)
    # Two passages exchanged have nearly the same k-mers, a repeated one exactly the same set.
    first, second = (" ".join(random_.choice(WORDS) + str(random_.randrange(50)) for _ in range(150)) for _ in range(2))
    texts = [first + " " + second, second + " " + first, first, " ".join([first] * 4)]
    frame = with_fingerprint(spark.createDataFrame([tuple(texts)], "a string, b string, c string, d string"), F.col("a"), "fa")
    for name in "bcd":
        frame = with_fingerprint(frame, F.col(name), f"f{name}")
    row = frame.select(likeness(F.col("fa"), F.col("fb")).alias("moved"), likeness(F.col("fc"), F.col("fd")).alias("again")).first()
    assert row["moved"] < 0.75 and row["again"] < 0.5


def test_likeness_falls_with_edits(spark):
    words = prose(1, 400).split(" ")
    rows = []
    for n in (0, 5, 40, 400):
        random_ = random.Random(n)
        rows.append((n, " ".join(random_.choice(WORDS) + "x" if random_.random() < n / 400 else w for w in words)))
    frame = with_fingerprint(spark.createDataFrame(rows, "n int, text string"), F.col("text"), "own")
    first = frame.where("n = 0").select(F.col("own").alias("first"))
    found = frame.crossJoin(first).select("n", likeness(F.col("own"), F.col("first")).alias("near")).orderBy("n").collect()
    near = [r["near"] for r in found]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] >= near[3] and near[3] < 0.1


def test_a_very_long_text_of_one_line(spark):
    text = "the same line again and again\n" * 40_000
    frame = with_fingerprint(spark.createDataFrame([(text,)], "text string"), F.col("text"), "own")
    assert len(set(frame.first()["own"])) > 1


@pytest.mark.parametrize("sketches", [0, 3, 24])
def test_sketches_are_a_power_of_two(spark, sketches):
    with pytest.raises(ValueError, match="power of two"):
        with_fingerprint(spark.range(1).select(F.lit("a").alias("t")), F.col("t"), sketches=sketches)
