"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from conftest_llm import as_sets
from pyspark.sql import functions as F

from quizloom.llm.merkle_manifest import built, document_manifest, folded, proofs
from quizloom.staging import staged

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
FAN = 16


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))


def levels(digests, fan):
    """All levels of a tree, from its leaves to the one node that remains."""
    found = [digests]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[i : i + fan])) for i in range(0, len(last), fan)])
    return found


def path(tree, place, fan):
    steps = []
    for level in tree[:-1]:
        start = place // fan * fan
        run = level[start : start + fan]
        steps.append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
        place //= fan
    return steps


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, fan=FAN):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]], fan)
    top = levels([trees[s][-1][0] for s in sources], fan)
    root = top[-1][0]
    for n, s in enumerate(sources):
        for place, r in enumerate(groups[s]):
            steps = path(trees[s], place, fan) + path(top, n, fan)
            shown = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                shown = leaf((r[0], lower(r[1]), *r[2:]))
            for before, after in steps:
                shown = sha(before + shown + after)
            yield r[0], leaf(r), trees[s][-1][0], root, sha("".join(a + b for a, b in steps)), shown, shown == root


def test_equals_plain_tree(docs, doc_rows):
    assert as_sets(document_manifest(docs), COLUMNS) == sorted(map(repr, plain(doc_rows)))


@pytest.mark.parametrize("fan", [2, 3])
def test_deep_trees_and_many_sources(spark, docs, fan):
    rows = [(i, f"Text {i}", None, f"s{min(i % 23, 9)}" if i % 31 else None, i) for i in range(300)]
    rows += [(-5, "ALONE", "en", "one of its own", 5), (7, "Text 7", None, "é", 7)]
    frame = spark.createDataFrame(rows, docs.schema).repartition(5)
    assert as_sets(document_manifest(frame, fan), COLUMNS) == sorted(map(repr, plain(rows, fan)))


def test_tampering_shows(docs):
    rows = document_manifest(docs).where("doc_id IS NOT NULL").collect()
    found = {r["doc_id"]: r["verified"] for r in rows}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    for k, verified in found.items():
        changed = zlib.crc32(str(k).encode()) % 5 == 0 and lower(texts[k]) != texts[k]
        assert verified != changed


def test_further_columns_and_no_rows(docs, crowded, no_docs):
    assert as_sets(document_manifest(crowded), COLUMNS) == as_sets(document_manifest(docs), COLUMNS)
    assert document_manifest(no_docs).collect() == []


def test_single_row(spark, docs):
    rows = [(1, "A", None, None, 1)]
    assert as_sets(document_manifest(spark.createDataFrame(rows, docs.schema)), COLUMNS) == [repr(r) for r in plain(rows)]


def test_single_requests(spark):
    leaves = spark.range(100).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("rank"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    records, subroots = built(leaves, 3)
    top, root = built(subroots.select("tree", F.col("tree").alias("rank"), "digest"), 3)
    root = root.first()["digest"]
    # A rank that the tree doesn't have, a tree that isn't there, and a negative rank have no proof.
    asked = spark.createDataFrame([(0, 0), (0, 42), (0, 99), (0, 100), (0, 5000), (3, 1), (0, -1)], "tree long, rank long")
    found = proofs(root, top, subroots, records, asked, 3)
    rows = found.select("rank", "digest", folded(F.col("digest"), F.col("path")).alias("root"), F.size("path").alias("n")).collect()
    assert sorted(r["rank"] for r in rows) == [0, 42, 99]
    assert all(r["root"] == root and r["digest"] == sha(str(r["rank"])) and r["n"] == 5 for r in rows)


def test_equal_subtrees_are_one_record(spark):
    equal = spark.range(54).select((F.col("id") % 2).alias("tree"), F.floor(F.col("id") / 2).alias("rank"), F.lit(sha("x")).alias("digest"))
    records, subroots = built(staged(equal, "equal"), 3)
    assert [r.count() for r in records] == [1, 1, 1] and subroots.select("digest").distinct().count() == 1
