"""The operators over their whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm import quality_crf, toxicity_kn
from quizloom.llm.common import in_fold, table
from quizloom.llm.decontamination import contaminated_documents
from quizloom.llm.embedding_lsh import near_vectors
from quizloom.llm.hard_negatives import hard_negatives
from quizloom.llm.language_id import learn_trees, predict_language
from quizloom.llm.line_dedup import dedup_lines
from quizloom.llm.lm_scoring import score_texts
from quizloom.llm.merkle_manifest import document_manifest
from quizloom.llm.order_minhash import fingerprint_edits
from quizloom.llm.piece_tokenizer import encode_texts
from quizloom.llm.quality_crf import learn_quality, score_quality
from quizloom.llm.simhash_trie import near_duplicates
from quizloom.llm.toxicity_kn import learn_toxicity, score_toxicity
from quizloom.llm.virtual_slots import shard_documents
from quizloom.staging import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def training_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """``doc_id`` and ``label`` of the training fold; a document with several labels takes the largest one."""
    labels = table(spark, sf_dir, "labels").where(~in_fold(F.col("doc_id"), 5))
    return labels.groupBy("doc_id").agg(F.max(label).cast("int").alias(label)).where(F.col(label).isNotNull())


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame, label: str, sample: int) -> DataFrame:
    """About ``sample`` labelled rows of each class to learn from, and as many with ``check`` for thresholds.

    ``weight`` is the number of rows that each one stands for. Labels are sampled before the texts are
    read: the sample is a small table, so the texts needn't be shuffled to meet it.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = training_labels(spark, sf_dir, label).withColumn("check", fold == 4)
    sizes = labels.groupBy(label, "check").count().collect()
    share = F.lit(1.0)
    for r in sizes:
        here = (F.col(label) == r[label]) & (F.col("check") == r["check"])
        share = F.when(here, min(1.0, sample / r["count"])).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52))
    labels = labels.where(place < share * (1 << 52)).withColumn("weight", 1 / share)
    chosen = staged(labels, "label-sample")
    return docs.join(chosen, "doc_id").select(
        F.col("doc_id").alias("key"), F.col("text").cast("binary").alias("text"), label, "check", "weight"
    )


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 10)
    return score_texts(docs, learn=~held_out).select("*", held_out.alias("held_out"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return contaminated_documents(docs, table(spark, sf_dir, "benchmark"))


@query
def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = labelled(spark, sf_dir, docs, "quality", quality_crf.SAMPLE)
    labels = training_labels(spark, sf_dir, "quality").where("quality IN (0, 1)")
    field = learn_quality(rows, prior=labels.agg(F.avg("quality")).first()[0])
    return score_quality(docs, field).select(
        "doc_id", in_fold(F.col("doc_id"), 5).alias("held_out"), "score", "predicted"
    )


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5)
    trees = learn_trees(docs, learn=~held_out)
    return predict_language(docs.select("doc_id", "text"), trees).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


@query
def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


@query
def op7_best_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts by the best sum of scores, which the given model's library doesn't take."""
    return encode_texts(table(spark, sf_dir, "documents"), by_score=True)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_toxicity(labelled(spark, sf_dir, docs, "toxic", toxicity_kn.SAMPLE))
    return score_toxicity(docs, model).select(
        "doc_id", in_fold(F.col("doc_id"), 5).alias("held_out"), "score", "predicted"
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, most_bits=4)


@query
def op10_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op10_embedding_lsh"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
),
good AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a),
part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, p.component_id, v.vec_id = p.component_id AS kept
FROM v LEFT JOIN degree d ON d.a = v.vec_id JOIN part p ON p.a = v.vec_id
"""


@query
def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a short ASCII text: bit by bit, -1 stands for a shift."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = (
        "CASE WHEN e >= 0 THEN xor(a, e) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END"
    )
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}::BIGINT[]), lambda a, e: {step}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 5 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS shown
  FROM documents
),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM l
),
up AS (
  SELECT tree, 0 AS h, place AS pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, h + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY tree, h, pos // 16
),
subroots AS (SELECT tree, h AS height, digest AS subroot, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS h, tree AS pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT h + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY h, pos // 16
),
step AS (
  SELECT leaves.tree, place, h AS s, u.pos, u.digest, u.pos = place // (16 ** h)::BIGINT AS own
  FROM leaves JOIN up u ON u.tree = leaves.tree AND u.n > 1 AND u.pos // 16 = place // (16 ** (h + 1))::BIGINT
  UNION ALL
  SELECT leaves.tree, place, height + h, t.pos, t.digest, t.pos = leaves.tree // (16 ** h)::BIGINT
  FROM leaves JOIN subroots USING (tree)
    JOIN top t ON t.n > 1 AND t.pos // 16 = leaves.tree // (16 ** (h + 1))::BIGINT
),
fold AS (
  SELECT tree, place, 0 AS s, coalesce(shown, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.tree, f.place, f.s + 1,
    sha256(string_agg(CASE WHEN step.own THEN f.digest ELSE step.digest END, '' ORDER BY step.pos))
  FROM fold f JOIN step ON step.tree = f.tree AND step.place = f.place AND step.s = f.s
  GROUP BY f.tree, f.place, f.s
),
folded AS (SELECT tree, place, arg_max(digest, s) AS folded_root FROM fold GROUP BY tree, place),
proof AS (
  SELECT tree, place, string_agg(digest, '' ORDER BY s, pos) AS siblings FROM step WHERE NOT own GROUP BY tree, place
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN folded USING (tree, place) LEFT JOIN proof USING (tree, place)
  CROSS JOIN (SELECT digest AS root FROM top WHERE n = 1)
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("vec_id")
    label = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), anchor=key % 50 == 0, label=label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
