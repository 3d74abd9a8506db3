"""The registered queries over their whole tables: columns, rows and what their contracts promise."""

import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from quizloom.llm.common import table
from quizloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double",
    "op3_quality_crf": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_virtual_slots": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, "
    "grown_shard int",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_order_minhash": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op12_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean",
    "op13_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint",
    "op10_embedding_lsh": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
}


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(QUERIES) <= names
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_and_columns(spark, name):
    found = QUERIES[name](spark, SF)
    types = dict(found.dtypes)
    if name.startswith("op13_"):
        assert found.dtypes == [tuple(c.split(" ")) for c in COLUMNS[name].split(", ")]
        return
    for column in COLUMNS.get(name, "doc_id bigint").split(", "):
        key, kind = column.split(" ")
        assert types[key] == kind
    key = "vec_id" if "vec_id" in types else "doc_id"
    source = table(spark, SF, "embeddings" if key == "vec_id" else "documents")
    rows = found.collect()
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in source.select(key).collect())
    folds = 10 if name.startswith("op1_") else 5
    for r in rows:
        if "held_out" in types:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == 0)
        if "near_edited" in types:
            assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if "predicted" in types:
            assert 0 <= r["score"] <= 1
            assert r["predicted"] == int(r["score"] >= (0.3 if name.startswith("op3_") else 0.5))


def test_edited_texts_are_nearer_than_the_next_ones(spark):
    rows = QUERIES["op11_order_minhash"](spark, "/root/testdata/sf0.01").where("n_chars >= 100").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.95 * len(rows)
    same = {}
    for r in rows:
        same.setdefault(r["fingerprint"], set()).add(r["n_chars"])
    assert len(same) > 0.8 * len(rows)


def test_model_beats_words_on_held_out_texts(spark):
    rows = QUERIES["op1_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for kind in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {kind} AS SELECT * FROM '/root/testdata/sf0.01/{kind}.parquet'")
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall())
    assert sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.01").select(columns).collect())) == want
