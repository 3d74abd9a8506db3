"""Editions, areas and ranges."""

from pyspark.sql import functions as F

from quizloom.fixed_values import AREA_FIXES, SUBJECT_AREAS
from quizloom.functions import names
from quizloom.operators import enrich
from quizloom.operators.assemble import with_base_metadata
from quizloom.plans.catalog.registry import query, table

EXAM_NAME = """CASE p_partkey % 4 WHEN 0 THEN 'other' WHEN 1 THEN 'x-oab-7-y'
    ELSE concat('oab-', replace(p_brand, 'Brand#', '')) END"""


@query(
    f"""
    WITH n AS (SELECT p_partkey, {EXAM_NAME} AS exam_name,
        CASE WHEN p_partkey % 3 = 0 THEN p_size END AS preset FROM part),
    f AS (SELECT *, nullif(regexp_extract(exam_name, 'oab-([0-9]+)', 1), '')::int AS found FROM n)
    SELECT p_partkey, exam_name, 2018 AS year, coalesce(preset, found) AS edition,
        CASE WHEN preset IS NULL AND found IS NOT NULL THEN 'pdf' END AS source_format
    FROM f
    """
)
def edition_fill(spark, sf_dir):
    """The edition in the name counts only where none is set."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr(EXAM_NAME).alias("exam_name"),
        F.expr("if(p_partkey % 3 = 0, p_size, null)").alias("edition"),
        F.lit(None).cast("string").alias("source_format"),
    )
    return with_base_metadata(enrich.fill_numbered_edition(rows), year=2018)


DATED_NAME = """CASE WHEN o_orderpriority LIKE '4%' THEN 'other' ELSE concat('enam-',
    cast(year(o_orderdate) as varchar(4)), CASE WHEN month(o_orderdate) < 7 THEN '1' ELSE '2' END,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'r' ELSE '' END) END"""


@query(
    f"""
    WITH n AS (SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
        {DATED_NAME} AS exam_name FROM orders)
    SELECT o_orderkey, exam_name,
        CASE WHEN exam_name = 'other' THEN o_orderstatus ELSE substr(exam_name, 6) END AS edition,
        CASE WHEN exam_name = 'other' THEN 1 ELSE year(o_orderdate)::int END AS year,
        CASE WHEN exam_name <> 'other' THEN CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 2 END
            END AS semester,
        CASE WHEN exam_name <> 'other' THEN o_orderpriority LIKE '1%' END AS reapplication,
        CASE WHEN exam_name <> 'other' THEN 'pdf' END AS source_format
    FROM n
    """
)
def edition_composite(spark, sf_dir):
    """Values from the name replace those already there."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(DATED_NAME).alias("exam_name"),
        F.col("o_orderstatus").alias("edition"),
        F.lit(1).alias("year"),
    )
    return enrich.set_dated_edition(rows)


STEM = """concat(CASE WHEN o_custkey % 50 = 0 THEN 'x' ELSE '' END,
    cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(o_orderkey % 25 + 1 as varchar(4)), 2, '0'),
    CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE '' END)"""


@query(
    f"""
    SELECT o_orderkey, {STEM} AS stem,
        CASE WHEN o_custkey % 50 <> 0 THEN year(o_orderdate)::int END AS year,
        (o_orderkey % 25 + 1)::int AS edition
    FROM orders
    """
)
def edition_from_stem(spark, sf_dir):
    stem = F.col("stem")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", F.expr(STEM).alias("stem"))
        .withColumns({"year": names.stem_year(stem), "edition": names.stem_edition(stem)})
    )


RAW_AREAS = [*SUBJECT_AREAS, *AREA_FIXES, "ASTRONOMY", "ethics", ""]
CLEAN_AREAS = [*SUBJECT_AREAS, *AREA_FIXES.values(), "NI", "NI", "NI"]


@query(
    f"SELECT p_partkey, {CLEAN_AREAS!r}[p_partkey % {len(RAW_AREAS)} + 1] AS area FROM part"
)
def area_normalize(spark, sf_dir):
    """Areas with Unicode blanks around them, misspelt and unknown ones."""
    areas = F.array(*[F.lit(area) for area in RAW_AREAS])
    raw = F.get(areas, (F.col("p_partkey") % len(RAW_AREAS)).cast("int"))
    blank = F.when(F.col("p_size") % 2 == 0, "  ").otherwise("\t")
    return table(spark, sf_dir, "part").select(
        "p_partkey", enrich.normalized_area(F.concat(blank, raw, blank)).alias("area")
    )


@query(
    """
    WITH ranges AS (
        SELECT p_brand AS edition, p_type AS label, min(p_partkey) AS ord,
            min(p_size) + 1 AS s, max(p_size) - 2 AS e FROM part GROUP BY ALL),
    hits AS (
        SELECT p_partkey, arg_min(label, ord) AS hit FROM part
        JOIN ranges ON edition = p_brand AND p_size BETWEEN s AND e GROUP BY ALL)
    SELECT p_partkey, p_brand AS edition, p_size AS question_number,
        coalesce(hit, CASE WHEN p_partkey % 2 = 0 THEN 'KEPT' END) AS area
    FROM part LEFT JOIN hits USING (p_partkey)
    """
)
def range_lookup(spark, sf_dir):
    """Overlapping ranges per brand: the first in list order wins."""
    part = table(spark, sf_dir, "part")
    ranges = part.groupBy(F.col("p_brand").alias("edition"), F.col("p_type").alias("label")).agg(
        F.min("p_partkey").alias("ord"),
        (F.min("p_size") + 1).alias("start_q"),
        (F.max("p_size") - 2).alias("end_q"),
    )
    rows = part.select(
        "p_partkey",
        F.col("p_brand").alias("edition"),
        F.col("p_size").alias("question_number"),
        F.expr("if(p_partkey % 2 = 0, 'KEPT', null)").alias("area"),
    )
    return enrich.label_by_range(rows, ranges)


@query(
    """
    WITH ranges AS (
        SELECT o_orderkey AS ord, o_orderkey - o_custkey % 700 AS s, o_orderkey + o_custkey % 500 - 90 AS e,
            o_orderpriority AS label FROM orders),
    hits AS (
        SELECT c_custkey, arg_min(label, ord) AS hit FROM customer JOIN ranges ON c_custkey BETWEEN s AND e GROUP BY ALL)
    SELECT c_custkey, 'all' AS edition, c_custkey AS question_number, coalesce(hit, c_mktsegment) AS area
    FROM customer LEFT JOIN hits USING (c_custkey)
    """
)
def range_lookup_overlaps(spark, sf_dir):
    """Every order a range of one edition, many over one another and some empty; the first in list order wins."""
    ranges = table(spark, sf_dir, "orders").select(
        F.lit("all").alias("edition"),
        F.col("o_orderkey").alias("ord"),
        F.expr("o_orderkey - o_custkey % 700").alias("start_q"),
        F.expr("o_orderkey + o_custkey % 500 - 90").alias("end_q"),
        F.col("o_orderpriority").alias("label"),
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lit("all").alias("edition"),
        F.col("c_custkey").alias("question_number"),
        F.col("c_mktsegment").alias("area"),
    )
    return enrich.label_by_range(rows, ranges)
