from types import SimpleNamespace

import pytest

from quizloom.staging import ROW, staged, staged_with_row, staging_path, staging_root


def session(folder, master):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_named_folder_is_used():
    assert staging_root(session("hdfs:///shared", "yarn")) == "hdfs:///shared"
    assert staging_path(session("hdfs:///shared/", "yarn"), "x").startswith("hdfs:///shared/x-")


def test_temporary_folder_only_in_local_mode():
    first = staging_root(session(None, "local[4]"))
    assert first == staging_root(session(None, "local[4]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(session(None, "spark://host:7077"))


def test_staged(spark):
    df = spark.sql("SELECT id, parse_json(concat('{\"n\":', id, '}')) AS v FROM range(5)")
    assert staged(df, "test").selectExpr("id", "v:n::int AS n").where("id = n").count() == 5
    numbered = staged_with_row(df, "test")
    assert numbered.select(ROW).distinct().count() == 5
    assert "FileScan" in numbered._jdf.queryExecution().executedPlan().toString()
