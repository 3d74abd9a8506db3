"""Tokens, decontamination, shards and the pipeline."""

import itertools
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from conftest_llm import as_sets, prose
from pyspark.sql import functions as F

import corpus_pipeline
from quizloom.llm.decontamination import (
    MASKS,
    WINDOW,
    clean_documents,
    contaminated_documents,
    find_overlaps,
    overlap,
    seeds_at,
)
from quizloom.llm.piece_tokenizer import UNIGRAM, VOCABULARY, Decoder, Encoder, Model, decode_ids, encode_texts
from quizloom.llm.virtual_slots import first_map, grown, read_map, rebalanced, shard_documents, write_shards


@pytest.fixture(scope="module")
def model():
    return Model(VOCABULARY)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def test_ids_equal_the_library_and_give_texts_back(spark, docs, doc_rows, crowded, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    got = encode_texts(docs)
    want = sorted(repr((i, library.encode(t or ""))) for i, t, *_ in doc_rows)
    assert as_sets(got, ["doc_id", "ids"]) == want
    assert {r["doc_id"] for r in got.where("NOT round_trip").collect()} == {20}
    back = decode_ids(got.where("round_trip"))
    texts = [(i, t or "") for i, t, *_ in doc_rows if i != 20]
    assert as_sets(back, ["doc_id", "text"]) == sorted(map(repr, texts))
    assert as_sets(encode_texts(crowded), ["doc_id", "ids", "n_tokens"]) == as_sets(got, ["doc_id", "ids", "n_tokens"])
    assert encode_texts(no_docs).count() == 0 and decode_ids(encode_texts(no_docs)).count() == 0
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert dict(decode_ids(null).collect()) == {1: None, 2: ""}


def test_random_texts_equal_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    encoder, decoder, draw = Encoder(model), Decoder(model), random.Random(6)
    for _ in range(3000):
        text = "".join(draw.choices("abcthe  ▁\n éß漢😀.,!in\t0", k=draw.randrange(30)))
        ids = ids_of(encoder, text)
        assert ids == library.encode(text)
        assert decoder.decode(ids) == text.replace("▁", " ")
    for n in (1, 2, 15, 16, 17, 40, 333):
        assert ids_of(encoder, " " * n + "x") == library.encode(" " * n + "x")


def test_very_long_words(model):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    encoder, draw = Encoder(model), random.Random(8)
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzé0123456789", k=50_000))
    assert ids_of(encoder, text) == library.encode(text)
    assert ids_of(encoder, "a" * 9_999) == library.encode("a" * 9_999)
    assert len(encoder) == 0


def test_every_text_is_decoded(model):
    """A round trip is tried on the ids at hand, of ordinary texts too."""
    encoder = Encoder(model)
    for text in ("the cat sat", "two\nlines", "ação, 1234", ""):
        assert encoder.comes_back(text, encoder.encode(text))
        assert not encoder.comes_back(text, encoder.encode("another text"))
    assert not encoder.comes_back("the cat sat", encoder.encode("the cat sat")[:-4])


def test_a_unigram_model_gets_the_best_sum(model):
    other = Model.__new__(Model)
    other.__dict__ = {k: v for k, v in model.__dict__.items() if k != "_encoder"} | {"kind": UNIGRAM, "halves": {}}
    encoder = Encoder(other)
    score = {other.texts[i]: other.scores[i] for i in other.normal}

    def best(text):
        if not text:
            return 0.0
        return max(
            (best(text[:-n]) + score[text[-n:]] for n in range(1, len(text) + 1) if text[-n:] in score),
            default=float("-inf"),
        )

    for word in ("▁the", "▁antion", "▁xyzzy", "▁rethble", "▁1234"):
        assert sum(score[p] for p in encoder.best(word)) == pytest.approx(best(word))


def test_best_sums_of_whole_texts(spark, docs, model):
    score = {model.texts[i]: model.scores[i] for i in model.normal}

    def best(text):
        """The best sum of scores that ends at each place, over all pieces; other characters are bytes."""
        total = [0.0]
        for end in range(1, len(text) + 1):
            ways = [total[a] + score[text[a:end]] for a in range(max(0, end - 24), end) if text[a:end] in score]
            total.append(max(ways) if ways else total[-1] if text[end - 1] not in known else float("-inf"))
        return total[-1]

    known = {c for piece in score for c in piece}
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id <> 13 AND doc_id <> 18").collect()}
    rows = encode_texts(docs, by_score=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in texts:
            text = texts[r["doc_id"]] or ""
            marked = "▁" + text.replace(" ", "▁") if text else ""
            assert r["score"] == pytest.approx(best(marked), rel=1e-9), text[:50]
            assert r["round_trip"] == ("▁" not in text) and r["n_tokens"] == len(r["ids"])


def test_every_window_with_two_substitutions_has_a_seed():
    tokens = np.arange(1, WINDOW + 1, dtype=np.uint64)
    for bad in itertools.combinations(range(WINDOW), 2):
        other = tokens.copy()
        other[list(bad)] += np.uint64(1000)
        assert any(np.isin(seeds_at(tokens, m, i), seeds_at(other, m, i)).any() for i, m in enumerate(MASKS))


def test_short_items_are_found_whichever_words_differ(spark):
    items, rows = [], []
    for n in range(4, 13):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        allowed = n - -(-8 * n // 10)
        for bad in itertools.combinations(range(n), allowed):
            text = " ".join("other" if i in bad else w for i, w in enumerate(words))
            rows.append((len(rows), f"some words before {text} and some after", n))
        text = " ".join("other" if i <= allowed else w for i, w in enumerate(words))
        rows.append((len(rows), f"some words before {text} and some after", None))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, want long")
    got = {r["doc_id"]: r["items"] for r in contaminated_documents(docs, benchmark).collect()}
    assert got == {i: [] if n is None else [n] for i, _, n in rows}


def plain_overlap(doc, item, window=13, least=0.8):
    """Whether some window of the two, laid side by side in any way, agrees."""
    if len(item) < 4:
        return 0 < len(item) and doc == item
    size = min(window, len(item))
    for a in range(len(doc) - size + 1):
        for b in range(len(item) - size + 1):
            if sum(x == y for x, y in zip(doc[a : a + size], item[b : b + size])) >= least * size - 1e-9:
                return True
    return False


def test_decontamination_equals_all_alignments(spark):
    draw = random.Random(21)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [[draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 4, 5, 8, 12, 13, 14, 20]))] for _ in range(30)]
    rows = []
    for _ in range(150):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 30))]
        item = draw.choice(items)
        a = draw.randrange(len(item))
        piece = [w if draw.random() < 0.85 else draw.choice(vocabulary) for w in item[a if draw.random() < 0.4 else 0 :]]
        at = draw.randrange(len(words) + 1)
        rows.append(words[:at] + piece + words[at:])
    rows += [list(i) for i in items[:10]]
    benchmark = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(n, " ".join(r)) for n, r in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["items"] for r in contaminated_documents(docs, benchmark).collect()}
    want = {n: [i for i, item in enumerate(items) if plain_overlap(r, item)] for n, r in enumerate(rows)}
    assert got == want and sum(map(bool, want.values())) > 40


def test_overlaps_are_measured_along_the_diagonal():
    doc, item = np.arange(100, 140, dtype=np.uint64), np.arange(110, 125, dtype=np.uint64)
    assert overlap(doc, item, 10, 13, 0.8) == (10, 25)
    assert overlap(doc, item, 11, 13, 0.8) is None
    item[[4, 8]] = 0
    assert overlap(doc, item, 10, 13, 0.8) == (10, 25)
    item[12] = 0
    assert overlap(doc, item, 10, 13, 0.8) is None


@pytest.fixture(scope="module")
def exams(spark):
    items = [(i, prose(500 + i, n)) for i, n in enumerate([40, 25, 13, 9, 3, 60])]
    items += [(6, None), (7, ""), (None, prose(507, 30)), (0, items[0][1])]
    return items


def test_leaks_are_found_and_clean_documents_stay(spark, exams, docs, crowded, no_docs):
    benchmark = spark.createDataFrame(exams, "item_id long, text string")
    text = dict(exams)
    words = text[0].split()
    changed = list(words)
    for at in range(3, 40, 7):
        changed[at] = "SUBSTITUTE"
    rows = [
        (100, prose(1, 30) + "\n" + text[0].upper() + ". " + prose(2, 30)),
        (101, " ".join(changed)),
        (102, prose(3, 10) + " " + text[3] + " " + prose(4, 10)),
        (103, prose(5, 50) + " " + " ".join(words[5:12]) + " " + prose(6, 50)),
        (104, text[5] + " " + text[1]),
        (105, text[4]),
        (106, text[None]),
        (None, text[2]),
        (None, prose(7, 20)),
        (107, text[1]),
        (107, prose(8, 30)),
    ]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    everything = docs.select("doc_id", "text").union(extra)
    got = contaminated_documents(everything, benchmark).where("contaminated").collect()
    found = sorted((str(r["doc_id"]), r["items"]) for r in got)
    assert found == [
        ("100", [0]), ("101", [0]), ("102", [3]), ("104", [1, 5]), ("105", [4]), ("106", [None]), ("107", [1]), ("None", [2]),
    ]
    spans = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in got}
    assert spans[100] == [(30, 70)] and spans[101] == [(0, 40)] and spans[102] == [(10, 19)]
    kept = clean_documents(everything, benchmark)
    assert kept.count() == everything.count() - len(got)
    # A small filter lets more seeds through; the overlaps are the same.
    names = ["key", "item", "start", "stop"]
    coarse, fine = find_overlaps(everything, benchmark, bits=10), find_overlaps(everything, benchmark)
    assert as_sets(coarse, names) == as_sets(fine, names)
    assert clean_documents(crowded, benchmark).columns == crowded.columns
    assert clean_documents(no_docs, benchmark).count() == 0
    assert clean_documents(docs, benchmark.limit(0)).count() == docs.count()


def test_shards_hold_equal_bytes_and_every_place(docs, doc_rows, crowded, no_docs):
    got = shard_documents(docs, shards=3).collect()
    assert len(got) == len(doc_rows)
    facts = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in doc_rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == facts
    for shard in {r["shard"] for r in got}:
        places = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert places == list(range(len(places)))
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    assert shard_documents(no_docs, shards=8).count() == 0
    names = ["doc_id", "size", "shard"]
    assert as_sets(shard_documents(crowded, shards=3), names) == sorted(
        repr((r["doc_id"], r["size"], r["shard"])) for r in got
    )


def test_maps_are_edited_by_version(spark, docs, tmp_path):
    draw = np.random.default_rng(1)
    sizes = draw.integers(0, 1000, 4096)
    owner = rebalanced(first_map(8), sizes, 8)
    loads = np.bincount(owner, sizes, 8)
    assert loads.max() - loads.min() <= 20
    assert (owner != first_map(8)).mean() < 0.2
    more = grown(owner, sizes, 8)
    assert set(more[more != owner]) == {8}
    loads = np.bincount(more, sizes, 9)
    assert loads.max() < 1.01 * loads.mean()
    shard_documents(docs, shards=4, map_path=f"{tmp_path}/map").count()
    first, second = (read_map(spark, f"{tmp_path}/map", v) for v in (1, 2))
    assert first.count() == second.count() == 4096
    write_shards(docs, second, f"{tmp_path}/shards")
    written = spark.read.parquet(f"{tmp_path}/shards")
    want = {(r["doc_id"], r["size"], r["shard"]) for r in shard_documents(docs, shards=4).collect()}
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    assert {tuple(r) for r in written.select("doc_id", size, "_shard").collect()} == want


def test_pipeline_stages(spark, tmp_path, doc_rows):
    sf_dir = str(tmp_path)
    exam = prose(900, 40)
    rows = [(i, t, lang or "en", s, n) for i, t, lang, s, n in doc_rows]
    rows += [(30, prose(901, 20) + "\n" + exam, "en", "s", 1), (31, prose(902, 60), "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(0, exam)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{sf_dir}/{number}-{name}.parquet")
        if number + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = spark.read.parquet(f"{sf_dir}/{number}-{name}.parquet")
    ids = {r["doc_id"] for r in docs.collect()}
    assert 31 in ids and 13 in ids and 1 in ids
    assert not ids & {2, 6, 7, 8, 9, 30}
    ran = corpus_pipeline.run(spark, sf_dir)
    assert as_sets(ran, ["doc_id", "ids"]) == as_sets(docs, ["doc_id", "ids"])
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
