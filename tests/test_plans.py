"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quizloom.operators import assemble
from quizloom.plans.catalog.assembly import document_parts, label_answers

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "CollectLimit"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert [word for word in FORBIDDEN if word in plan] == []


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_stitching_and_join_share_a_shuffle(spark, no_broadcast):
    """Large tables: one exchange of the parts serves the grouping and the join."""
    parts = document_parts(spark, SF_DIR)
    answers = label_answers(spark, SF_DIR).select(
        "exam", "numero", F.lit(1).alias("page"), F.lit(0).alias("pos"), "resposta"
    )
    rows = assemble.join_answers(
        assemble.merge_split_questions(parts), assemble.collect_answers(answers)
    )
    rows.collect()
    final = plan_of(rows).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in final


@pytest.mark.parametrize(
    "name, columns",
    [
        ("minimum_size", {"doc_id", "text"}),
        ("answer_key_first_wins", {"user_id", "props", "ts", "event_id", "event_type"}),
        ("nullified_count", {"doc_id", "source", "quality"}),
        ("split_count", {"conv_id", "role"}),
    ],
)
def test_scans_read_only_needed_columns(spark, name, columns):
    frame = entry.queries()[name](spark, SF_DIR)
    frame.collect()
    final = plan_of(frame).split("Initial Plan")[0]
    read = set()
    for part in final.split("ReadSchema: struct<")[1:]:
        read |= {field.split(":")[0] for field in part.split(">")[0].split(",")}
    assert read <= columns
