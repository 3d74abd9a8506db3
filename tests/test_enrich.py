import random

import pytest
from pyspark.sql import functions as F

from quizloom.functions import names
from quizloom.operators import enrich


@pytest.mark.parametrize(
    "name, preset, edition, source_format",
    [
        ("oab-26", None, 26, "pdf"),
        ("x-oab-7-y", None, 7, "pdf"),
        ("oab-26", 3, 3, None),
        ("other", None, None, None),
        ("oab-", None, None, None),
    ],
)
def test_fill_edition(spark, name, preset, edition, source_format):
    rows = spark.createDataFrame(
        [(name, preset, None)], "exam_name string, edition int, source_format string"
    )
    (row,) = enrich.fill_numbered_edition(rows).collect()
    assert (row.edition, row.source_format) == (edition, source_format)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("enam-20241", ("20241", 2024, 1, False, "pdf")),
        ("enam-20242r", ("20242r", 2024, 2, True, "pdf")),
        ("my-enam-20251-x", ("20251", 2025, 1, False, "pdf")),
        ("enam-2024", ("old", 1, None, None, None)),
        ("other", ("old", 1, None, None, None)),
    ],
)
def test_set_edition(spark, name, expected):
    rows = spark.createDataFrame([(name, "old", 1)], "exam_name string, edition string, year int")
    (row,) = enrich.set_dated_edition(rows).collect()
    assert (row.edition, row.year, row.semester, row.reapplication, row.source_format) == expected


RANGES = [
    (26, 0, 1, 8, "ETHICS"),
    (26, 1, 5, 12, "CIVIL"),
    (26, 3, 20, 30, "late"),
    (26, 2, 20, 30, "early"),
    (26, 4, 40, 50, ""),
    (0, 0, 1, 99, "zero"),
]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_ranges(spark, threshold):
    """The same with and without a broadcast join."""
    cases = [
        (26, 1, "ETHICS"),
        (26, 8, "ETHICS"),
        (26, 9, "CIVIL"),
        (26, 12, "CIVIL"),
        (26, 13, "had"),
        (26, 25, "early"),
        (26, 45, "had"),
        (27, 1, "had"),
        (0, 5, "had"),
        (None, 5, "had"),
    ]
    ranges = spark.createDataFrame(
        RANGES, "edition int, ord int, start_q int, end_q int, label string"
    )
    rows = spark.createDataFrame(
        [(e, n, "had") for e, n, _ in cases], "edition int, question_number int, area string"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        found = enrich.label_by_range(rows, ranges).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, cases))


def test_ranges_without_previous_label(spark):
    ranges = spark.createDataFrame(
        [("20241", 0, 1, 2, "CIVIL")],
        "edition string, ord int, start_q int, end_q int, label string",
    )
    rows = spark.createDataFrame(
        [("20241", 1), ("20241", 3), ("", 1)], "edition string, question_number int"
    )
    found = enrich.label_by_range(rows, ranges, label="subject").collect()
    assert {tuple(r) for r in found} == {("20241", 1, "CIVIL"), ("20241", 3, None), ("", 1, None)}


def first_ranges(ranges, points):
    """The label of the first range that holds each point, one after another."""
    found = {}
    for _, start, end, label in sorted(ranges):
        for x in points:
            if x not in found and start <= x <= end:
                found[x] = label
    return found


def test_ranges_equal_a_plain_search(spark):
    random_ = random.Random(2)
    edges = [0, 1, -1, 2**31 - 1, -(2**31), 2**62, -(2**62)]
    ranges = []
    for i in range(400):
        start = random_.choice([random_.randrange(-300, 300), random_.choice(edges)])
        end = random_.choice([min(start + random_.randrange(-3, 200), 2**62), random_.choice(edges)])
        ranges.append((random_.randrange(100_000) * 1000 + i, start, end, f"r{i}"))
    points = sorted({*range(-320, 520, 3), *edges})
    frame = spark.createDataFrame([("e", *r) for r in ranges], "edition string, ord long, start_q long, end_q long, label string")
    rows = spark.createDataFrame([("e", x) for x in points], "edition string, question_number long")
    got = {r.question_number: r.area for r in enrich.label_by_range(rows, frame).collect()}
    want = first_ranges(ranges, points)
    assert got == {x: want.get(x) for x in points}


def test_an_edition_of_many_ranges(spark):
    n = 100_000
    ranges = spark.range(n).select(
        F.lit("e").alias("edition"), (F.lit(n) - F.col("id")).alias("ord"), F.col("id").alias("start_q"),
        (F.col("id") + F.col("id") % 1000).alias("end_q"), F.col("id").cast("string").alias("label"),
    )
    rows = spark.range(0, n, 997).select(F.lit("e").alias("edition"), F.col("id").alias("question_number"))
    frame = enrich.label_by_range(rows, ranges)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    # The first in the list is the one that starts last.
    assert all(r.area == str(r.question_number) for r in frame.collect())


def test_no_points_go_through_the_driver(spark, tmp_path):
    """A table small by its file is not broadcast once a level; what is, is the row of the levels in use."""
    path = str(tmp_path / "numbers")
    spark.range(20_000).select(F.lit("e").alias("edition"), F.col("id").alias("question_number")).write.parquet(path)
    ranges = spark.range(300).select(
        F.lit("e").alias("edition"), F.col("id").alias("ord"), (F.col("id") * 50).alias("start_q"),
        (F.col("id") * 50 + 99).alias("end_q"), F.col("id").cast("string").alias("label"),
    )
    points = spark.read.parquet(path).select("edition", F.col("question_number").alias("number")).distinct()
    found = enrich.range_labels(points, ranges)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.number: r.hit for r in found.collect()} == {x: str(max(0, x // 50 - 1)) for x in range(300 * 50 + 50)}
    assert enrich.used_levels(ranges).first()[0] < 1 << 7
    assert enrich.used_levels(ranges.limit(0)).first()[0] == 0


def test_pack_metadata(spark):
    rows = spark.createDataFrame([(1, None, 25)], "n int, area string, edition int")
    packed = enrich.pack_metadata(rows, ["area", "edition"])
    assert packed.select("n", F.to_json("metadata")).collect()[0][:] == (1, '{"edition":25}')


def test_names(spark):
    rows = spark.createDataFrame(
        [("/a/b/x-prova.pdf",), ("x.y.pdf",), ("noext",), (".pdf",)], "path string"
    )
    found = [r[0] for r in rows.select(names.file_stem(F.col("path"))).collect()]
    assert found == ["x-prova", "x.y", "noext", ".pdf"]
    rows = spark.createDataFrame([("x-prova",), ("x-prova-prova",), ("x",)], "s string")
    found = [r[0] for r in rows.select(names.without_suffix(F.col("s"), "-prova")).collect()]
    assert found == ["x", "x-prova", "x"]
    found = rows.select(names.without_suffix(F.col("s"), "a.ova")).collect()
    assert [r[0] for r in found] == ["x-prova", "x-prova-prova", "x"]
