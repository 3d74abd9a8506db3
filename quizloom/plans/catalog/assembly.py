"""Stitching, answer keys and the flagship build."""

from pyspark.sql import functions as F

from quizloom.functions.names import question_id
from quizloom.operators import assemble, enrich, pairing, rawtext
from quizloom.operators.ordering import with_position
from quizloom.plans.catalog.registry import (
    JOINED_SQL,
    joined,
    lines_as_alternatives,
    query,
    table,
)
from quizloom.sinks.export import tabular
from quizloom.staging import staged

DOCUMENT_KEY = "concat('set-', doc_id % 16)"


def document_parts(spark, sf_dir):
    """Documents as question parts: a question is spread over several documents."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("exam"),
        F.expr("doc_id div 40").alias("numero"),
        F.col("doc_id").alias("page"),
        F.lit(0).alias("pos"),
        F.col("text").alias("enunciado"),
        lines_as_alternatives().alias("alternativas"),
        "lang",
    )


def turn_parts(spark, sf_dir):
    """Conversation turns as parts of one question per conversation and role."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("exam"),
        F.col("role").alias("numero"),
        F.col("turn").alias("page"),
        F.lit(0).alias("pos"),
        F.col("text").alias("enunciado"),
        lines_as_alternatives().alias("alternativas"),
    )


def whole_documents(spark, sf_dir):
    """Each document as one question."""
    return table(spark, sf_dir, "documents").select(
        F.expr(DOCUMENT_KEY).alias("exam"),
        F.col("doc_id").alias("numero"),
        F.col("text").alias("enunciado"),
        lines_as_alternatives().alias("alternativas"),
    )


def label_answers(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.expr(DOCUMENT_KEY).alias("exam"),
        F.col("doc_id").alias("numero"),
        F.when(F.col("quality") == 1, "A").otherwise("").alias("resposta"),
        "toxic",
    )


def benchmark_blocks(spark, sf_dir):
    """Benchmark items as tagged raw-text blocks."""
    text = """concat('Questão ', item_id, '\n\nAREA ',
        element_at(array('ETHICS', 'PHILOSHOPY', '', 'ASTRONOMY'), cast(item_id % 4 + 1 as int)),
        '\n\n', text, '\n\nOPTIONS\n\nA) ', length(text), '\n\nB:CORRECT) ', md5(text), '\n')"""
    return table(spark, sf_dir, "benchmark").select(
        F.expr("concat('2010-', item_id % 25 + 1)").alias("stem"),
        F.lit(0).alias("block_no"),
        F.expr(text).alias("block"),
    )


@query(
    f"""
    SELECT *, row_number() OVER (ORDER BY question_number, exam_source, id, branch) AS position FROM (
    WITH parts AS (
        SELECT source AS exam, doc_id // 40 AS numero, doc_id AS page, lang, text,
            string_split(text, chr(10)) AS alts FROM documents),
    merged AS (
        SELECT exam, numero, string_agg(text, ' ' ORDER BY page) AS statement,
            arg_max(alts, {{'s': len(alts), 'p': page}}) AS alts FROM parts GROUP BY ALL),
    answers AS (
        SELECT source AS exam, doc_id // 40 AS numero,
            arg_min(CASE WHEN quality = 1 THEN 'A' ELSE 'B' END, doc_id) AS answer,
            bool_or(toxic = 1) AS flagged
        FROM labels JOIN documents USING (doc_id) GROUP BY ALL),
    ranges AS (
        SELECT exam, upper(lang) AS label, min(page) AS ord, min(numero) AS s, max(numero) AS e
        FROM parts GROUP BY ALL),
    areas AS (
        SELECT m.exam, m.numero, arg_min(label, ord) AS area FROM merged m
        JOIN ranges r ON r.exam = m.exam AND m.numero BETWEEN s AND e GROUP BY ALL)
    SELECT 'page' AS branch, printf('%s-%03d', exam, numero) AS id, exam AS exam_source,
        numero AS question_number, md5(statement) AS statement_md5,
        md5({JOINED_SQL}) AS alternatives_md5, len(alts)::int AS n_alternatives,
        CASE WHEN NOT coalesce(flagged, false) THEN answer END AS correct_answer,
        (coalesce(flagged, false) OR answer IS NULL) AS nullified, area
    FROM merged LEFT JOIN answers USING (exam, numero) LEFT JOIN areas USING (exam, numero)
    UNION ALL
    SELECT 'text', printf('oab-%d-%03d', item_id % 25 + 1, item_id),
        printf('oab-%d', item_id % 25 + 1), item_id,
        md5(trim(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'))),
        md5('A:' || length(text) || '|B:' || md5(text)), 2, 'B', false,
        ['ETHICS', 'PHILOSOPHY', 'NI', 'NI'][item_id % 4 + 1]
    FROM benchmark)
    """
)
def build_dataset(spark, sf_dir):
    """Both branches: stitched, answered, labelled by range, united, in dataset order."""
    parts = staged(document_parts(spark, sf_dir), "document-parts")
    labels = table(spark, sf_dir, "labels")
    sources = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("exam"))
    answered = labels.join(sources, "doc_id").select(
        "exam",
        F.expr("doc_id div 40").alias("numero"),
        F.col("doc_id").alias("page"),
        F.lit(0).alias("pos"),
        F.when(F.col("quality") == 1, "A").otherwise("B").alias("resposta"),
        "toxic",
    )
    ranges = parts.groupBy(F.col("exam").alias("edition"), F.upper("lang").alias("label")).agg(
        F.min("page").alias("ord"),
        F.min("numero").alias("start_q"),
        F.max("numero").alias("end_q"),
    )
    page_rows = assemble.join_answers(
        assemble.merge_split_questions(parts),
        assemble.collect_answers(answered),
        answered.where("toxic = 1"),
    )
    page_rows = enrich.label_by_range(page_rows, ranges, edition="exam_source")
    text_rows = rawtext.good_questions(rawtext.parse_blocks(benchmark_blocks(spark, sf_dir)))
    columns = [
        "id",
        "exam_source",
        F.col("question_number").cast("long").alias("question_number"),
        F.md5("statement").alias("statement_md5"),
        F.md5(joined("alternatives", "letter", "text")).alias("alternatives_md5"),
        F.size("alternatives").alias("n_alternatives"),
        "correct_answer",
        "nullified",
        "area",
    ]
    rows = page_rows.select(F.lit("page").alias("branch"), *columns).unionByName(
        text_rows.select(F.lit("text").alias("branch"), *columns)
    )
    return with_position(rows, [F.col(name) for name in ("question_number", "exam_source", "id", "branch")])


PAIRING_SQL = """
    WITH files AS (
        SELECT DISTINCT conv_id, role, 'conv-' || conv_id AS exam_name,
            '/exams/conv-' || conv_id || '-' || role || '.pdf' AS path FROM conversations),
    e AS (SELECT exam_name, path AS exam_path FROM files WHERE role = 'user'),
    k AS (SELECT exam_name, path AS key_path FROM files WHERE role = 'system')
"""


def conversation_files(spark, sf_dir):
    listing = table(spark, sf_dir, "conversations").select(
        F.expr("concat('/exams/conv-', conv_id, '-', role, '.pdf')").alias("path")
    )
    return pairing.documents_by_base(listing, "-user", "-system")


@query(
    PAIRING_SQL
    + """SELECT exam_name, exam_path, key_path, row_number() OVER (ORDER BY exam_path) AS position
    FROM e JOIN k USING (exam_name)"""
)
def pair_documents(spark, sf_dir):
    """Pairs with their place in path order."""
    found = pairing.pairs(conversation_files(spark, sf_dir))
    return with_position(found, [F.col("exam_path")])


@query(PAIRING_SQL + "SELECT exam_name, exam_path FROM e ANTI JOIN k USING (exam_name)")
def orphan_documents(spark, sf_dir):
    return pairing.unpaired_exams(conversation_files(spark, sf_dir))


@query(
    """
    WITH rows AS (
        SELECT source, doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos,
            unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT source AS exam, doc_id AS page, pos::int AS pos, pos::int + 1 AS numero,
        md5(line) AS statement_md5
    FROM rows
    """
)
def explode_pages(spark, sf_dir):
    """Every line of a document as its questions; benchmark items as pages without any, or with null."""
    questions = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            (i + 1).alias("numero"),
            line.alias("enunciado"),
            F.array().cast("array<struct<letra:string,texto:string>>").alias("alternativas"),
        ),
    )
    pages = table(spark, sf_dir, "documents").select(
        F.col("source").alias("exam"), F.col("doc_id").alias("page"), questions.alias("questoes")
    )
    none = F.when(F.col("item_id") % 2 == 0, F.array().cast(pages.schema["questoes"].dataType))
    empty = table(spark, sf_dir, "benchmark").select(
        F.lit("empty").alias("exam"), F.col("item_id").alias("page"), none.alias("questoes")
    )
    return assemble.explode_questions(pages.unionByName(empty)).select(
        "exam", "page", "pos", "numero", F.md5("enunciado").alias("statement_md5")
    )


TURNS_SQL = """
    WITH parts AS (
        SELECT conv_id::varchar AS exam, role AS numero, turn AS page, text,
            string_split(text, chr(10)) AS alts FROM conversations),
    merged AS (
        SELECT exam, numero, string_agg(text, ' ' ORDER BY page) AS statement,
            arg_max(alts, {'s': len(alts), 'p': page}) AS alts, count(*) AS parts
        FROM parts GROUP BY ALL)
"""


@query(
    TURNS_SQL
    + f"""SELECT exam, numero, md5(statement) AS statement_md5,
        md5({JOINED_SQL}) AS alternatives_md5, parts FROM merged"""
)
def merge_split_questions(spark, sf_dir):
    merged = assemble.merge_split_questions(turn_parts(spark, sf_dir))
    return merged.select(
        "exam",
        "numero",
        F.md5("enunciado").alias("statement_md5"),
        F.md5(joined("alternativas", "letra", "texto")).alias("alternatives_md5"),
        "parts",
    )


@query(
    """
    WITH p AS (
        SELECT source AS exam, doc_id // 40 AS numero, doc_id, text,
            (row_number() OVER (ORDER BY source, doc_id // 40, doc_id) - 1) // 7 AS piece
        FROM documents)
    SELECT exam, numero, piece, md5(string_agg(text, ' ' ORDER BY doc_id)) AS statement_md5,
        count(*) AS parts
    FROM p GROUP BY ALL
    """
)
def question_pieces(spark, sf_dir):
    """The long form of a question, one row per run of parts."""
    return assemble.question_pieces(document_parts(spark, sf_dir), parts_per_piece=7).select(
        "exam", "numero", "piece", F.md5("enunciado").alias("statement_md5"), "parts"
    )


@query(
    f"""
    WITH p AS (
        SELECT source AS exam, doc_id // 4000 AS numero, doc_id AS page, text,
            string_split(text, chr(10)) AS alts FROM documents),
    m AS (
        SELECT exam, numero, string_agg(text, ' ' ORDER BY page) AS statement,
            arg_max(alts, {{'s': len(alts), 'p': page}}) AS alts, count(*) AS parts FROM p GROUP BY ALL)
    SELECT exam, numero, md5(statement) AS statement_md5, md5({JOINED_SQL}) AS alternatives_md5, parts FROM m
    """
)
def merge_hot_questions(spark, sf_dir):
    """Questions of many parts, stitched in two steps of several pieces each."""
    parts = document_parts(spark, sf_dir).withColumn("numero", F.expr("page div 4000"))
    merged = assemble.merge_split_questions(parts, min_hot_parts=5, parts_per_piece=3)
    return merged.select(
        "exam",
        "numero",
        F.md5("enunciado").alias("statement_md5"),
        F.md5(joined("alternativas", "letra", "texto")).alias("alternatives_md5"),
        "parts",
    )


@query(TURNS_SQL + "SELECT exam, sum(parts - 1)::bigint AS splits FROM merged GROUP BY exam")
def split_count(spark, sf_dir):
    return assemble.split_count(assemble.merge_split_questions(turn_parts(spark, sf_dir)))


@query(
    """
    SELECT user_id::varchar AS exam, json_extract_string(props, '$.k')::int AS numero,
        arg_min(event_type, {'t': ts, 'i': event_id}) AS resposta
    FROM events GROUP BY ALL
    """
)
def answer_key_first_wins(spark, sf_dir):
    answers = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("exam"),
        F.get_json_object("props", "$.k").cast("int").alias("numero"),
        F.col("ts").alias("page"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("resposta"),
    )
    return assemble.collect_answers(answers)


def joined_rows(rows):
    return rows.select(
        "id",
        "exam_source",
        "question_number",
        F.md5("statement").alias("statement_md5"),
        "correct_answer",
        "nullified",
    )


@query(
    """
    SELECT printf('set-%d-%03d', doc_id % 16, doc_id) AS id,
        printf('set-%d', doc_id % 16) AS exam_source, doc_id AS question_number,
        md5(text) AS statement_md5,
        CASE quality WHEN 1 THEN 'A' WHEN 0 THEN '' END AS correct_answer,
        quality IS NULL AS nullified
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def join_answers(spark, sf_dir):
    """An empty answer counts as one; only a missing answer nullifies."""
    answers = label_answers(spark, sf_dir).drop("toxic")
    return joined_rows(assemble.join_answers(whole_documents(spark, sf_dir), answers))


@query(
    """
    SELECT printf('set-%d-%03d', doc_id % 16, doc_id) AS id,
        printf('set-%d', doc_id % 16) AS exam_source, doc_id AS question_number,
        md5(text) AS statement_md5,
        CASE WHEN toxic = 0 THEN CASE quality WHEN 1 THEN 'A' ELSE '' END END AS correct_answer,
        coalesce(toxic, 1) = 1 AS nullified
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def explicit_nullified(spark, sf_dir):
    answers = label_answers(spark, sf_dir)
    return joined_rows(
        assemble.join_answers(
            whole_documents(spark, sf_dir), answers.drop("toxic"), answers.where("toxic = 1")
        )
    )


@query(
    """
    SELECT 'lineitem' AS source, l_partkey AS part,
        printf('%d-%03d', l_orderkey, l_linenumber) AS id FROM lineitem
    UNION ALL SELECT 'orders', o_custkey, printf('o-%03d', o_orderkey) FROM orders
    """,
    name="question_id",
)
def make_question_id(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        F.lit("lineitem").alias("source"),
        F.col("l_partkey").alias("part"),
        question_id(F.col("l_orderkey").cast("string"), F.col("l_linenumber")).alias("id"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_custkey").alias("part"),
        question_id(F.lit("o"), F.col("o_orderkey")).alias("id"),
    )
    return items.unionByName(orders)


@query(
    f"""
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS alts FROM documents)
    SELECT doc_id, len(alts)::int AS n, md5({JOINED_SQL}) AS alternatives_md5 FROM d
    """
)
def reshape_alternatives(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", lines_as_alternatives().alias("alternativas")
    )
    return rows.withColumn("alternatives", assemble.output_alternatives()).select(
        "doc_id",
        F.size("alternatives").alias("n"),
        F.md5(joined("alternatives", "letter", "text")).alias("alternatives_md5"),
    )


@query(
    """
    WITH d AS (SELECT doc_id, source, lang, string_split(text, chr(10)) AS alts FROM documents)
    SELECT doc_id,
        md5('[' || array_to_string(list_transform(alts, lambda x, i:
            '{"letter":"' || chr((65 + (i - 1) % 26)::int) || '","text":' || to_json(x) || '}'), ',')
            || ']') AS alternatives_md5,
        '{' || CASE WHEN lang <> 'es' THEN '"area":"' || upper(lang) || '",' ELSE '' END
            || '"edition":' || doc_id % 45 || '}' AS metadata
    FROM d
    """
)
def flatten_tabular(spark, sf_dir):
    """Nested values as JSON text; an absent area leaves no key."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        lines_as_alternatives().alias("alternativas"),
        F.expr("if(lang = 'es', null, upper(lang))").alias("area"),
        F.expr("doc_id % 45").alias("edition"),
    )
    shaped = enrich.pack_metadata(
        rows.withColumn("alternatives", assemble.output_alternatives()), ["area", "edition"]
    )
    return tabular(shaped).select(
        "doc_id", F.md5("alternatives").alias("alternatives_md5"), "metadata"
    )
