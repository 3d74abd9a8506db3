"""SimHash, vectors, components and line dedup against brute force."""

import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from conftest_llm import as_sets
from pyspark.sql import functions as F

from quizloom.llm.components import Forest, components
from quizloom.llm.embedding_lsh import near_vectors
from quizloom.llm.line_dedup import chain, common_places, dedup_lines
from quizloom.llm.simhash_trie import near_duplicates, one_of_each, self_join


def plain_fingerprint(text, words=4):
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    shingles = [b" ".join(split[i : i + words]) for i in range(max(1, len(split) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("most_bits", [0, 4, 9])
def test_simhash_equals_all_pairs(docs, doc_rows, most_bits):
    got = near_duplicates(docs, most_bits=most_bits).collect()
    prints = {plain_fingerprint(r[1]) for r in doc_rows}
    links = [(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= most_bits]
    low = {}
    for doc_id, text, *_ in doc_rows:
        fp = plain_fingerprint(text)
        if doc_id is not None:
            low[fp] = min(low.get(fp, doc_id), doc_id)
    keyed = [(low[a], low[b]) for a, b in links if a in low and b in low]
    roots = plain_components(set(low.values()), keyed)
    want = sorted(
        repr((i, f"{plain_fingerprint(t):016x}", roots.get(low.get(plain_fingerprint(t))))) for i, t, *_ in doc_rows
    )
    assert sorted(repr(tuple(r)) for r in got) == want


def test_trie_join_equals_all_pairs_on_clusters():
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(40)]
    values = {c for c in centres}
    for c in centres:
        for _ in range(30):
            near = c
            for _ in range(draw.randrange(9)):
                near ^= 1 << draw.randrange(64)
            values.add(near)
    values = np.array(sorted(values), np.uint64)
    forest = Forest(len(values))
    self_join(values, np.zeros(len(values), np.uint64), 0, 4, forest)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = plain_components(range(len(values)), list(zip(*np.nonzero(near))))
    assert forest.root.tolist() == [want[i] for i in range(len(values))]


def test_one_of_each_group_stays(docs, doc_rows, crowded, no_docs):
    kept = one_of_each(docs)
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect())
    classes = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    want = {i for i, c in classes.items() if i is not None and i == c}
    assert {i for null, i in ids if not null} == want
    assert len([i for null, i in ids if not null]) == len(want)
    assert kept.columns == docs.columns
    # The two null keys with texts of their own: one of them copies document 4.
    assert sum(null for null, _ in ids) == 1
    assert as_sets(one_of_each(crowded), docs.columns) == as_sets(kept, docs.columns)
    assert one_of_each(no_docs).count() == 0
    assert near_duplicates(no_docs).count() == 0


def test_components_of_long_chains_stars_and_loops(spark):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    links += [(5000 - i, 5000 - i - 1) for i in range(100)] + [(7, 7), (9000, 9000)]
    links += [(draw.randrange(20000, 20300), draw.randrange(20000, 20300)) for _ in range(250)]
    want = plain_components({x for link in links for x in link}, links)
    draw.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(11)
    rows, number = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = draw.standard_normal(24)
            for _ in range(draw.integers(1, 9)):
                number += 1
                vector = (centre + draw.standard_normal(24) * 0.15).astype(np.float32)
                rows.append((number, [float(x) for x in vector], label))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    rows += [(2000, None, 0), (2001, [0.0] * 24, 0), (2002, [float("nan")] * 24, 0), (2003, [1.0, None], 0)]
    rows += [(2004, [], 0), (2005, [float("inf")] + [1.0] * 23, 0), (None, rows[0][1], 0), (2006, [1.0, 0.0], 0)]
    rows += [(2007, [2.0, 0.1], 0), (2006, [1.0, 0.0], 0)]
    return rows


@pytest.mark.parametrize("block", [4, 2048])
def test_vectors_equal_all_pairs(spark, vectors, block):
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    frame = frame.withColumn("links", F.lit(1)).withColumn("bucket", F.lit(2))
    # Enough tables to miss nothing here.
    got = near_vectors(frame, tables=60, steps=6, block=block).collect()
    good = [
        (i, np.array(v, np.float64), lab)
        for i, v, lab in vectors
        if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    degree, links = {}, []
    for n, (a, x, label) in enumerate(good):
        degree[n] = 0
        for m, (b, y, other) in enumerate(good):
            if m != n and label == other and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    degree[n] += 1
                    links.append((a, b))
    roots = plain_components({i for i, _, _ in good}, links)
    want = [(i, degree[n], roots[i], i == roots[i]) for n, (i, _, _) in enumerate(good)]
    bad = len(vectors) - len(good)
    sound = {i for i, _, _ in good}
    want += [(i, 0, i, i is not None) for i, v, _ in vectors if i not in sound]
    assert len(want) == len(good) + bad
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors(empty).count() == 0


def test_lines_of_earlier_documents_go(docs, doc_rows, crowded, no_docs):
    got = dedup_lines(docs)
    rows = got.collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    text = {i: t for i, t, *_ in doc_rows}
    assert by_id[1][0]["text"] == text[1] and not by_id[1][0]["copy"]
    assert by_id[2][0]["copy"] and by_id[2][0]["text"] == "" and by_id[2][0]["n_deleted"] == 6
    # Document 3 is the first one and a short line; document 5 has three lines of the fourth.
    assert by_id[3][0]["text"] == text[3].split("\n")[-1]
    assert by_id[5][0]["text"].split("\n") == [text[5].split("\n")[0], text[5].split("\n")[-1]]
    assert by_id[6][0]["text"] is None and by_id[6][0]["n_lines"] == 0
    assert by_id[7][0]["text"] == "" and by_id[8][0]["text"] == text[8]
    assert by_id[14][0]["text"] == text[14]
    assert by_id[15][0]["n_deleted"] == 3 and by_id[15][0]["text"] == text[15].split("\n")[-1]
    assert [r["text"] for r in by_id[17]] == [text[17]] * 2
    copies = [r for r in by_id[None] if r["copy"]]
    assert len(copies) == 1 and copies[0]["n_deleted"] == 5
    assert len(rows) == len(doc_rows)
    names = ["doc_id", "text", "n_deleted"]
    assert as_sets(dedup_lines(crowded), names) == as_sets(got, names)
    assert dedup_lines(no_docs).count() == 0


def test_what_goes_is_kept_by_an_earlier_document(spark):
    draw = random.Random(2)
    lines = [" ".join(draw.choices("abcdefgh", k=draw.choice([3, 6, 12]))) for _ in range(25)]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randrange(1, 12)))) for i in range(60)]
    got = dict(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    held = set()
    for i, text in rows:
        before, after = text.split("\n"), got[i].split("\n") if got[i] else []
        places = iter(before)
        assert all(line in places for line in after)
        for line in before:
            assert line in after or line in held
            # A line that is a block by itself doesn't stay if an earlier document has it.
            if len(line.split()) >= 10 and line in held:
                assert line not in after
        held.update(before)


def test_blocks_need_neighbours_in_both():
    words = np.array([6, 6, 6, 6], np.int32)
    assert common_places([([0], [5]), ([1], [6])], words, 10) == [0, 1]
    assert common_places([([0], [5]), ([1], [7])], words, 10) == []
    assert common_places([([0, 2], [5]), ([1, 3], [6])], words, 10) == [0, 1, 2, 3]
    assert common_places([([0], [9]), ([1], [10]), ([2], [1]), ([3], [2])], words, 10) == [0, 1, 2, 3]


def plain_places(later, earlier, words, least):
    """The alignment with plain lists and sets, as its docstring has it."""
    gone = set()
    while True:
        rest = {x: [i for i, y in enumerate(later) if y == x and i not in gone] for x in later if x in earlier}
        others = {x: [i for i, y in enumerate(earlier) if y == x] for x in rest}
        match = {}

        def take(pairs):
            fresh = [(a, b) for a, b in pairs if a not in match and b not in match.values()]
            match.update(fresh)
            for step in (1, -1):
                for a, b in fresh:
                    while True:
                        a, b = a + step, b + step
                        line = later[a] if 0 <= a < len(later) and a not in gone else None
                        if line is None or not 0 <= b < len(earlier) or earlier[b] != line:
                            break
                        if len(rest[line]) == len(others[line]) == 1 or a in match or b in match.values():
                            break
                        match[a] = b

        once = sorted((rest[x][0], others[x][0]) for x in rest if len(rest[x]) == len(others[x]) == 1)
        take(chain(once))
        take(once)
        left = [
            p
            for x in rest
            for p in zip([a for a in rest[x] if a not in match], [b for b in others[x] if b not in match.values()])
        ]
        take(chain(sorted(left)))
        take(left)
        blocks = []
        for a in sorted(match):
            if blocks and a == blocks[-1][-1] + 1 and match[a] == match[a - 1] + 1:
                blocks[-1].append(a)
            else:
                blocks.append([a])
        blocks = [b for b in blocks if sum(words[later[a]] for a in b) >= least]
        if not blocks:
            return gone
        before = set(gone)
        for block in blocks:
            gone.update(block)
            free = 0
            for start in range(len(later) - len(block) + 1):
                places = range(start, start + len(block))
                same = [later[a] for a in places] == [later[a] for a in block]
                if same and start >= free and start not in before:
                    if gone.isdisjoint(places):
                        gone.update(places)
                    free = places.stop


def plain_dedup(texts, least=10):
    """Line dedup of texts in order, every pair of documents looked at."""
    originals, found = [], []
    for text in texts:
        lines = text.split("\n")
        if text in originals:
            found.append("")
            continue
        originals.append(text)
        gone = set()
        for earlier in dict.fromkeys(holders_of(originals, least)):
            words = {x: len(x.split()) for x in lines}
            gone |= plain_places(lines, earlier.split("\n"), words, least)
        found.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return found


def runs(text, least):
    lines = text.split("\n")
    for i, line in enumerate(lines):
        run, n = [], 0
        for x in lines[i:]:
            n += len(x.split())
            run += [x] if x.split() else []
            if n >= least:
                if line.split():
                    yield tuple(run)
                break


def holders_of(originals, least):
    """The first earlier holder of each run of the last text."""
    for run in runs(originals[-1], least):
        first = next(t for t in originals if run in set(runs(t, least)))
        if first != originals[-1]:
            yield first


def test_line_dedup_equals_plain_version(spark):
    random_ = random.Random(8)
    kinds = ["", " ", *[f"line {i} of five words" for i in range(4)], *[" ".join([f"w{i}"] * 12) for i in range(3)]]
    texts = []
    for _ in range(60):
        lines = [random_.choice(kinds) for _ in range(random_.randrange(1, 14))]
        if texts and random_.random() < 0.5:
            other = random_.choice(texts).split("\n")
            at = random_.randrange(len(other))
            lines[random_.randrange(len(lines)) :] = other[at : at + random_.randrange(1, 9)]
        texts.append("\n".join(lines) or "x")
    got = dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = plain_dedup(texts)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == dict(enumerate(want))


LONG = 100_000


@pytest.mark.parametrize(
    "line",
    [
        lambda i, side: 0 if i % 2 else (1 if i in (10, 12) else side * LONG + i),  # blank lines, two lines shared
        lambda i, side: 0 if i % 2 else (i if i // 100 % 2 else side * LONG + i),  # blank lines, half shared
        lambda i, side: 1,  # one line over and over
        lambda i, side: i if side == 1 else i * 7919 % LONG,  # every line moved
    ],
)
def test_long_documents_are_aligned_in_memory_of_their_size(line):
    later, earlier = {}, {}
    for i in range(LONG):
        later.setdefault(line(i, 1), []).append(i)
        earlier.setdefault(line(i, 2), []).append(i)
    words = np.array([0 if line(i, 1) == 0 else 12 for i in range(LONG)], np.int32)
    shared = [(later[x], earlier[x]) for x in later if x in earlier]
    tracemalloc.start()
    common_places(shared, words, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
