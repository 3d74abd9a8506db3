"""Exports read back, unions and dataset order."""

from functools import reduce

from pyspark.sql import functions as F

from quizloom.operators.assemble import output_alternatives
from quizloom.operators.ordering import dataset_order, with_position
from quizloom.plans import builds
from quizloom.plans.builds import (
    CORE_COLUMNS,
    DATED_KEYS,
    NUMBERED_KEYS,
    combined,
    dated_series_rows,
    finished,
    numbered_series_rows,
)
from quizloom.plans.catalog.assembly import benchmark_blocks
from quizloom.plans.catalog.registry import lines_as_alternatives, query, table
from quizloom.schemas import ALTERNATIVES, EXAM_QUESTION
from quizloom.sinks.export import CSV_READ, export, export_per_exam
from quizloom.sinks.published import drop_old_versions, publish_dataset, read_published
from quizloom.sources.files import question_dataset
from quizloom.staging import staging_path


def core_rows(documents):
    """Documents as dataset rows without metadata."""
    rows = documents.withColumns(
        {
            "id": F.expr("format_string('%s-%03d', source, doc_id)"),
            "exam_source": F.col("source"),
            "question_number": F.expr("doc_id % 80"),
            "statement": F.col("text"),
            "alternativas": lines_as_alternatives(),
            "correct_answer": F.expr("if(doc_id % 3 = 0, null, 'A')"),
            "nullified": F.expr("doc_id % 3 = 0"),
        }
    )
    return rows.withColumn("alternatives", output_alternatives())


def finished_rows(spark, sf_dir):
    rows = core_rows(table(spark, sf_dir, "documents")).select(
        *CORE_COLUMNS,
        F.expr("if(lang = 'es', null, upper(lang))").alias("area"),
        F.expr("if(doc_id % 7 = 0, null, cast(doc_id % 45 as int))").alias("edition"),
        F.lit(None).cast("int").alias("year"),
        F.col("lang").alias("source_format"),
    )
    return finished(rows, NUMBERED_KEYS)


def comparable():
    """Flat columns of a dataset read back."""

    def metadata(key, kind):
        return F.try_variant_get("metadata", f"$.{key}", kind).alias(key)

    return [
        F.col("id"),
        F.col("exam_source"),
        F.col("question_number"),
        F.md5("statement").alias("statement_md5"),
        F.size("alternatives").alias("n_alternatives"),
        F.col("correct_answer"),
        F.col("nullified"),
        metadata("area", "string"),
        metadata("edition", "int"),
        metadata("source_format", "string"),
    ]


ROWS_SQL = """
    SELECT printf('%s-%03d', source, doc_id) AS id, source AS exam_source,
        doc_id % 80 AS question_number, md5(text) AS statement_md5,
        len(string_split(text, chr(10)))::int AS n_alternatives,
        CASE WHEN doc_id % 3 <> 0 THEN 'A' END AS correct_answer, doc_id % 3 = 0 AS nullified,
        CASE WHEN lang <> 'es' THEN upper(lang) END AS area,
        CASE WHEN doc_id % 7 <> 0 THEN (doc_id % 45)::int END AS edition, lang AS source_format
    FROM documents
"""


def read_csv(spark, path):
    text_schema = EXAM_QUESTION.replace(ALTERNATIVES, "string").replace("variant", "string")
    rows = spark.read.options(**CSV_READ).schema(text_schema).csv(path)
    return rows.withColumns(
        {
            "alternatives": F.from_json("alternatives", ALTERNATIVES),
            "metadata": F.parse_json("metadata"),
        }
    )


@query(ROWS_SQL)
def export_jsonl(spark, sf_dir):
    path = export(finished_rows(spark, sf_dir), staging_path(spark, "export-jsonl"), "jsonl")
    return question_dataset(spark, path).select(*comparable())


@query(ROWS_SQL)
def export_csv(spark, sf_dir):
    path = export(finished_rows(spark, sf_dir), staging_path(spark, "export-csv"), "csv")
    return read_csv(spark, path).select(*comparable())


@query(f"SELECT 'jsonl' AS fmt, * FROM ({ROWS_SQL}) UNION ALL SELECT 'csv', * FROM ({ROWS_SQL})")
def export_both(spark, sf_dir):
    base = staging_path(spark, "export-both")
    export(finished_rows(spark, sf_dir), base, "both")
    json_rows = question_dataset(spark, f"{base}.jsonl")
    csv_rows = read_csv(spark, f"{base}.csv")
    return json_rows.select(F.lit("jsonl").alias("fmt"), *comparable()).unionByName(
        csv_rows.select(F.lit("csv").alias("fmt"), *comparable())
    )


@query(f"SELECT 1 AS version, * FROM ({ROWS_SQL}) WHERE source_format = 'en' UNION ALL SELECT 2, * FROM ({ROWS_SQL})")
def export_versions(spark, sf_dir):
    """A dataset published twice: the first version stays readable beside the second."""
    root, rows = staging_path(spark, "published"), finished_rows(spark, sf_dir)
    publish_dataset(rows.where("metadata:source_format::string = 'en'"), root)
    publish_dataset(rows, root, "both")
    drop_old_versions(spark, root, keep=2)
    first = read_published(spark, root, version=1).select(F.lit(1).alias("version"), *comparable())
    return first.unionByName(read_published(spark, root).select(F.lit(2).alias("version"), *comparable()))


@query(f"SELECT * FROM ({ROWS_SQL}) WHERE question_number BETWEEN 17 AND 23 AND exam_source = 'src3'")
def export_range(spark, sf_dir):
    """One exam's numbers of a range, from the parts of the export that may hold them."""
    root = staging_path(spark, "indexed")
    order = [F.col("exam_source"), F.col("question_number"), F.col("id")]
    publish_dataset(finished_rows(spark, sf_dir), root, order=order)
    return read_published(spark, root, numbers=(17, 23), exam="src3").select(*comparable())


@query(f"SELECT exam_source AS folder, * FROM ({ROWS_SQL})")
def export_per_edition(spark, sf_dir):
    """Rows and the folder each was written to."""
    path = export_per_exam(finished_rows(spark, sf_dir), staging_path(spark, "per-exam"))
    folder = F.regexp_extract("_metadata.file_path", "/source=([^/]+)/", 1)
    return question_dataset(spark, path).select(folder.alias("folder"), *comparable())


@query(
    """
    SELECT printf('%s-%03d', source, doc_id) AS id,
        CASE WHEN lang IN ('de', 'en') THEN lang ELSE 'rest' END AS branch, md5(text) AS statement_md5
    FROM documents
    UNION ALL SELECT printf('%s-%03d', source, doc_id), 'again', md5(text) FROM documents
    WHERE lang = 'en'
    """
)
def union_branches(spark, sf_dir):
    """Two languages, all other rows, and one language again: equal ids are all kept."""
    documents = table(spark, sf_dir, "documents")
    named = F.coalesce(F.col("lang").isin("de", "en"), F.lit(False))
    branches = [
        core_rows(documents.where(F.col("lang") == lang)).withColumn("branch", F.lit(lang))
        for lang in ("de", "en")
    ]
    branches.append(core_rows(documents.where(~named)).withColumn("branch", F.lit("rest")))
    again = core_rows(documents.where("lang = 'en'")).withColumn("branch", F.lit("again"))
    rows = reduce(lambda a, b: a.unionByName(b), [*branches, again])
    return rows.select("id", "branch", F.md5("statement").alias("statement_md5"))


@query(
    """
    SELECT printf('enam-2024%d-%03d', doc_id % 2 + 1, doc_id % 80) AS id,
        '{"edition":"2024' || (doc_id % 2 + 1) || '","reapplication":false,"semester":'
            || (doc_id % 2 + 1) || ',"source_format":"pdf","year":2024}' AS metadata
    FROM documents WHERE lang = 'en'
    UNION ALL
    SELECT printf('oab-%d-%03d', doc_id % 20 + 26, doc_id % 80),
        '{"edition":' || doc_id % 20 + 26 || ',"source_format":"pdf"}'
    FROM documents WHERE lang <> 'en'
    """.replace("doc_id % 20 + 26 ||", "(doc_id % 20 + 26) ||")
)
def union_products(spark, sf_dir):
    """Two series whose editions differ in type, united with VARIANT metadata."""
    documents = table(spark, sf_dir, "documents")

    def series(condition, name):
        source = F.expr(name)
        rows = core_rows(documents.where(condition)).withColumn("exam_source", source)
        return rows.withColumn(
            "id", F.format_string("%s-%03d", source, F.col("question_number"))
        ).select(*CORE_COLUMNS)

    dated = dated_series_rows(series("lang = 'en'", "concat('enam-2024', doc_id % 2 + 1)"))
    numbered = numbered_series_rows(
        None, series("lang <> 'en'", "concat('oab-', doc_id % 20 + 26)")
    )
    rows = combined(finished(dated, DATED_KEYS), finished(numbered, NUMBERED_KEYS))
    return rows.select("id", F.to_json("metadata").alias("metadata"))


def document_pages(documents, exam):
    """Exam pages of one question each, and key pages for a third of the documents."""
    number = F.expr("doc_id % 80").alias("numero")
    question = F.struct(number, F.col("text").alias("enunciado"))
    answer = F.struct(number, F.lit("A").alias("resposta"))

    def pages(kind, name, item):
        return documents.select(
            F.expr(exam).alias("exam"),
            F.lit(kind).alias("doc_kind"),
            F.col("doc_id").cast("int").alias("page"),
            F.to_json(F.struct(F.array(item).alias(name))).alias("payload"),
        )

    keys = pages("gabarito", "respostas", answer).where(F.col("page") % 3 == 0)
    return pages("prova", "questoes", question).unionByName(keys)


@query(
    """
    WITH d AS (
        SELECT *, doc_id % 80 AS n, CASE WHEN lang = 'en' THEN 'dated' ELSE 'numbered' END AS series,
            CASE WHEN lang = 'en' THEN 'enam-2024' || (doc_id % 2 + 1)
                ELSE 'oab-' || (doc_id % 20 + 26) END AS exam FROM documents),
    q AS (
        SELECT series, exam, n, string_agg(text, ' ' ORDER BY doc_id) AS statement,
            bool_or(doc_id % 3 = 0) AS answered FROM d GROUP BY ALL)
    SELECT series, printf('%s-%03d', exam, n) AS id, md5(statement) AS statement_md5,
        CASE WHEN answered THEN 'A' END AS correct_answer, NOT answered AS nullified,
        CASE series WHEN 'dated' THEN '{"edition":"' || substr(exam, 6) || '","reapplication":false,"semester":'
            || substr(exam, 10) || ',"source_format":"pdf","year":2024}'
            ELSE '{"edition":' || substr(exam, 5) || ',"source_format":"pdf"}' END AS metadata
    FROM q
    UNION ALL
    SELECT 'numbered', printf('oab-%d-%03d', item_id % 25 + 1, item_id),
        md5(trim(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'))), 'B', false,
        '{"area":"' || ['ETHICS', 'PHILOSOPHY', 'NI', 'NI'][item_id % 4 + 1] || '","edition":'
            || (item_id % 25 + 1) || ',"source_format":"raw_text","year":2010}'
    FROM benchmark
    """
)
def build_all(spark, sf_dir):
    """Both series from payloads and raw text, exported, and read back."""
    documents = table(spark, sf_dir, "documents")
    paths = builds.build_all(
        spark,
        document_pages(documents.where("lang = 'en'"), "concat('enam-2024', doc_id % 2 + 1)"),
        document_pages(documents.where("lang <> 'en'"), "concat('oab-', doc_id % 20 + 26)"),
        benchmark_blocks(spark, sf_dir),
        staging_path(spark, "build-all"),
    )
    written = [
        question_dataset(spark, path).withColumn("series", F.lit(series))
        for series, path in zip(("dated", "numbered"), paths)
    ]
    return written[0].unionByName(written[1]).select(
        "series",
        "id",
        F.md5("statement").alias("statement_md5"),
        "correct_answer",
        "nullified",
        F.to_json("metadata").alias("metadata"),
    )


@query(
    """
    WITH r AS (
        SELECT doc_id, printf('%s-%03d', source, doc_id) AS id, doc_id % 80 AS n,
            CASE WHEN doc_id % 7 <> 0 THEN doc_id % 45 ELSE 0 END AS edition FROM documents)
    SELECT 'number_first' AS sorted_by, id, row_number() OVER (ORDER BY n, edition, id) AS position
    FROM r
    UNION ALL
    SELECT 'edition_first', id, row_number() OVER (ORDER BY edition, n, id) FROM r
    """
)
def order_dataset(spark, sf_dir):
    """Position of each row in both orders."""
    rows = finished_rows(spark, sf_dir).select("id", "question_number", "edition")
    orders = [
        with_position(rows, dataset_order(order)).select(
            F.lit(order).alias("sorted_by"), "id", "position"
        )
        for order in ("number_first", "edition_first")
    ]
    return orders[0].unionByName(orders[1])
