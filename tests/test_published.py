import gzip

import pytest
from pyspark.sql import functions as F

from quizloom.schemas import EXAM_QUESTION_COLUMNS
from quizloom.sinks import published
from quizloom.sinks.export import export
from quizloom.sinks.published import drop_old_versions, publish_dataset, published_files, read_published
from quizloom.versions import versions


def rows(spark, n, text="s"):
    # The exam changes with the number, so that parts of either order hold few of them.
    frame = spark.range(n).select(
        F.format_string("e%02d-%03d", F.col("id") % 7, F.col("id")).alias("id"),
        F.format_string("e%02d", F.col("id") % 7).alias("exam_source"),
        F.col("id").alias("question_number"),
        F.lit(text + '",\n"').alias("statement"),
        F.array().cast("array<struct<letter:string,text:string>>").alias("alternatives"),
        F.lit(None).cast("string").alias("correct_answer"),
        F.lit(True).alias("nullified"),
        F.parse_json(F.lit("{}")).alias("metadata"),
    )
    return frame.select(*EXAM_QUESTION_COLUMNS)


def numbers(frame):
    return sorted(r.question_number for r in frame.collect())


def test_versions(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish_dataset(rows(spark, 5), root, "both", per_exam=True) == 1
    old = read_published(spark, root)
    assert publish_dataset(rows(spark, 9, "new"), root) == 2
    assert numbers(old) == list(range(5)) and numbers(read_published(spark, root)) == list(range(9))
    assert numbers(read_published(spark, root, version=1)) == list(range(5))
    with pytest.raises(ValueError, match="not written"):
        published_files(spark, root, "csv")
    assert published_files(spark, root, "csv", version=1)
    drop_old_versions(spark, root)
    assert versions(spark, root) == [2] and numbers(read_published(spark, root)) == list(range(9))
    assert [p.name for p in (tmp_path / "set" / "data").iterdir()] == ["v=2"]


def test_a_job_that_dies_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "set")
    publish_dataset(rows(spark, 300), root)
    failing = rows(spark, 400).withColumn(
        "statement", F.when(F.col("question_number") == 390, F.raise_error(F.lit("lost"))).otherwise(F.lit("x"))
    )
    with pytest.raises(Exception, match="lost"):
        publish_dataset(failing, root)
    assert numbers(read_published(spark, root)) == list(range(300))


def test_a_job_that_dies_between_formats_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    publish_dataset(rows(spark, 3), root, "both")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(published, "part_index", die)
        with pytest.raises(RuntimeError):
            publish_dataset(rows(spark, 8), root, "both")
    assert numbers(read_published(spark, root)) == [0, 1, 2]
    # The next one takes the number of the one that died, and nothing of it is left.
    assert publish_dataset(rows(spark, 4), root, "both") == 2
    assert numbers(read_published(spark, root)) == [0, 1, 2, 3]
    assert not (tmp_path / "set" / "data" / "v=3").exists()


@pytest.mark.parametrize("fmt", ["jsonl", "csv"])
def test_only_parts_of_the_range_are_opened(spark, tmp_path, fmt):
    root = str(tmp_path / "set")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish_dataset(rows(spark, 400).repartition(5), root, fmt)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = published_files(spark, root, fmt)
    some = published_files(spark, root, fmt, numbers=(10, 20))
    assert len(every) == 4 and len(some) == 1 and set(some) < set(every)
    assert published_files(spark, root, fmt, numbers=(500, 600)) == []
    if fmt == "jsonl":
        frame = read_published(spark, root, numbers=(10, 20), exam="e03")
        assert numbers(frame) == [10, 17]
        assert {f.rsplit("/", 1)[1] for f in frame.inputFiles()} == {f.rsplit("/", 1)[1] for f in some}
        assert read_published(spark, root, numbers=(500, 600)).collect() == []
        assert read_published(spark, root, exam="f").collect() == []


def test_index_by_exam(spark, tmp_path):
    root = str(tmp_path / "set")
    publish_dataset(rows(spark, 210), root, order=[F.col("exam_source"), F.col("question_number")])
    assert numbers(read_published(spark, root, exam="e05")) == list(range(5, 210, 7))


def test_empty_dataset(spark, tmp_path):
    root = str(tmp_path / "set")
    publish_dataset(rows(spark, 0), root)
    assert read_published(spark, root).collect() == []


def test_publishing_writes_no_table_on_the_way(spark, tmp_path, monkeypatch):
    """The rows are kept by the executors, not written once more before they are sorted."""
    from quizloom import staging

    monkeypatch.setattr(staging, "staged", lambda *_: pytest.fail("a table was written"))
    path = str(tmp_path / "published")
    assert publish_dataset(rows(spark, 20), path, "both") == 1
    assert read_published(spark, path).count() == 20
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


@pytest.mark.parametrize("fmt", ["jsonl", "csv"])
def test_parts_are_gzip_files_of_the_same_lines(spark, tmp_path, fmt):
    """Published parts hold what an export holds, in the same order, in far fewer bytes."""
    root, wanted = str(tmp_path / "set"), rows(spark, 400, "a text that comes again and again, " * 20).repartition(5)
    publish_dataset(wanted, root, "both", per_exam=True)
    export(wanted, str(tmp_path / "plain"), "both")
    plain = [p.read_bytes() for p in sorted((tmp_path / f"plain.{fmt}").glob("part-*"))]
    parts = sorted((tmp_path / "set" / "data" / "v=1" / f"all.{fmt}").glob("part-*"))
    assert [p.name.split("-c000.")[1] for p in parts] == [f"{'json' if fmt == 'jsonl' else 'csv'}.gz"] * len(parts)
    lines = [b"".join(texts).splitlines() for texts in (plain, [gzip.decompress(p.read_bytes()) for p in parts])]
    header = lines[0][0] if fmt == "csv" else None
    assert [x for x in lines[0] if x != header] == [x for x in lines[1] if x != header]
    assert sum(p.stat().st_size for p in parts) < sum(map(len, plain)) / 3
    assert len(published_files(spark, root, fmt)) == len(parts)
    assert all(p.name.endswith(".gz") for p in (tmp_path / "set" / "data" / "v=1" / "per-edition").rglob("part-*"))


def test_plain_versions_are_read_beside_packed_ones(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    with monkeypatch.context() as patched:
        patched.setattr(published, "PACKED", {})
        publish_dataset(rows(spark, 30), root, "both")
    publish_dataset(rows(spark, 50), root, "both")
    assert not any(f.endswith(".gz") for f in published_files(spark, root, version=1))
    assert all(f.endswith(".gz") for f in published_files(spark, root))
    for version, n in ((1, 30), (2, 50)):
        assert numbers(read_published(spark, root, numbers=(7, 99), version=version)) == list(range(7, n))


def test_executors_keep_no_rows_in_memory(spark, tmp_path, monkeypatch):
    """One format is written without keeping rows; for two, the sorted ones are kept on disk alone."""
    from quizloom.sinks import export as sink

    kept, held, levels, write = [], sink.held, [], sink._write

    def watched(frame):
        kept.append(frame)
        return held(frame)

    def seen(frame, *args, **options):
        levels.append((frame.storageLevel.useMemory, frame.storageLevel.useDisk))
        write(frame, *args, **options)

    monkeypatch.setattr(sink, "held", watched)
    monkeypatch.setattr(sink, "_write", seen)
    publish_dataset(rows(spark, 20), str(tmp_path / "one"))
    assert not kept and levels == [(False, False)]
    publish_dataset(rows(spark, 20), str(tmp_path / "two"), "both")
    assert len(kept) == 1 and levels[1:] == [(False, True)] * 2
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
