"""Usage, cost, failures and summaries."""

from pyspark.sql import functions as F

from quizloom.operators import report, usage
from quizloom.operators.ordering import with_position
from quizloom.plans.catalog.registry import query, table

USAGE_SQL = """
    WITH u AS (
        SELECT CASE WHEN conv_id % 100 > 0 THEN 'conv-' || conv_id % 100 END AS exam,
            CASE WHEN turn % 2 = 1 THEN 'Model-FLASH-1' ELSE 'model-1' END AS model,
            CASE WHEN role <> 'assistant' THEN length(text) END AS input_tokens,
            CASE WHEN role = 'assistant' THEN length(text) END AS output_tokens,
            length(text) AS total_tokens FROM conversations)
"""


def turn_usage(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.expr("if(conv_id % 100 > 0, concat('conv-', conv_id % 100), null)").alias("exam"),
        F.expr("if(turn % 2 = 1, 'Model-FLASH-1', 'model-1')").alias("model"),
        F.expr("if(role <> 'assistant', cast(length(text) as bigint), null)").alias("input_tokens"),
        F.expr("if(role = 'assistant', cast(length(text) as bigint), null)").alias("output_tokens"),
        F.expr("cast(length(text) as bigint)").alias("total_tokens"),
    )


@query(
    USAGE_SQL
    + """SELECT CASE WHEN grouping(exam) = 0 THEN exam END AS exam, grouping(exam) = 1 AS is_total,
        sum(coalesce(input_tokens, 0))::bigint AS input_tokens,
        sum(coalesce(output_tokens, 0))::bigint AS output_tokens,
        sum(total_tokens)::bigint AS total_tokens
    FROM u GROUP BY ROLLUP (exam)"""
)
def token_usage(spark, sf_dir):
    """Sums per exam, unknown exams as one, and, as one more row, for the run."""
    return usage.usage_by_exam(turn_usage(spark, sf_dir))


@query(
    USAGE_SQL
    + """SELECT CASE WHEN grouping(exam) = 0 THEN exam END AS exam, grouping(exam) = 1 AS is_total, round(sum(
        coalesce(input_tokens, 0) / 1e6 * CASE WHEN model LIKE '%FLASH%' THEN 0.5 ELSE 2 END
        + coalesce(output_tokens, 0) / 1e6 * CASE WHEN model LIKE '%FLASH%' THEN 3 ELSE 12 END),
        8)::double AS cost_usd
    FROM u GROUP BY ROLLUP (exam)"""
)
def token_cost(spark, sf_dir):
    costs = usage.cost_by_exam(turn_usage(spark, sf_dir))
    return costs.select("exam", "is_total", F.round("cost_usd", 8).alias("cost_usd"))


PAGES_SQL = """
    WITH p AS (
        SELECT 'user-' || user_id AS exam, event_id AS page, event_type = 'error' AS failed,
            CASE WHEN event_id % 4 = 0 THEN 'gabarito' ELSE 'prova' END AS doc_kind,
            CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k')::int ELSE 0 END
                AS found FROM events)
"""


def event_pages(spark, sf_dir):
    """Events as extracted pages; error events are the failed ones."""
    return table(spark, sf_dir, "events").select(
        F.expr("concat('user-', user_id)").alias("exam"),
        F.expr("if(event_id % 4 = 0, 'gabarito', 'prova')").alias("doc_kind"),
        F.col("event_id").alias("page"),
        F.expr("event_type = 'error'").alias("failed"),
        F.expr("if(event_type <> 'error', cast(get_json_object(props, '$.k') as int), 0)").alias(
            "found"
        ),
    )


@query(
    PAGES_SQL
    + """SELECT exam, (doc_kind = 'gabarito')::int AS kind_rank, page,
        CASE WHEN doc_kind = 'gabarito' THEN 'gab-' ELSE '' END || page AS label,
        row_number() OVER (ORDER BY exam, doc_kind = 'gabarito', page) AS position
    FROM p WHERE failed"""
)
def failed_pages(spark, sf_dir):
    """Failed pages in order: by exam, exam pages before key pages, each by number."""
    found = report.failed_pages(event_pages(spark, sf_dir))
    return with_position(found, [F.col(name) for name in ("exam", "kind_rank", "page")])


@query(
    PAGES_SQL
    + """SELECT exam, count_if(doc_kind = 'prova')::bigint AS exam_pages,
        count_if(doc_kind = 'gabarito')::bigint AS key_pages,
        count_if(failed)::bigint AS failed_pages,
        sum(CASE WHEN doc_kind = 'prova' THEN found ELSE 0 END)::bigint AS questions_found
    FROM p GROUP BY exam"""
)
def page_totals(spark, sf_dir):
    return report.page_totals(event_pages(spark, sf_dir))


ROWS_SQL = """
    WITH r AS (
        SELECT source AS exam_source, CASE WHEN lang = 'en' THEN 'text' ELSE 'page' END AS branch,
            CASE WHEN lang <> 'es' THEN substr(source, 4)::int END AS edition,
            quality IS NULL AS nullified
        FROM documents LEFT JOIN labels USING (doc_id))
"""


def document_rows(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source", "lang")
        .join(labels, "doc_id", "left")
        .select(
            F.col("source").alias("exam_source"),
            F.expr("if(lang = 'en', 'text', 'page')").alias("branch"),
            F.expr("if(lang <> 'es', cast(substr(source, 4) as int), null)").alias("edition"),
            F.col("quality").isNull().alias("nullified"),
        )
    )


@query(
    ROWS_SQL
    + """SELECT count(*) AS questions, count_if(branch = 'text')::bigint AS text_questions,
        count_if(branch = 'page')::bigint AS page_questions, count(DISTINCT edition) AS editions,
        coalesce(min(edition), 0) AS first_edition, coalesce(max(edition), 0) AS last_edition
    FROM r"""
)
def dataset_summary(spark, sf_dir):
    return report.dataset_summary(document_rows(spark, sf_dir))


@query(
    ROWS_SQL
    + """SELECT exam_source, count_if(nullified)::bigint AS nullified FROM r GROUP BY exam_source"""
)
def nullified_count(spark, sf_dir):
    return report.per_exam_counts(document_rows(spark, sf_dir)).select("exam_source", "nullified")


@query(ROWS_SQL + "SELECT exam_source, count(*) AS questions FROM r GROUP BY exam_source")
def per_edition_counts(spark, sf_dir):
    counts = report.per_exam_counts(document_rows(spark, sf_dir))
    return counts.select("exam_source", "questions").orderBy("exam_source")
