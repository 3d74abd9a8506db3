"""Tasks need nothing of this repository on their machines: the driver alone has it on its path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate()
)


def missing(batches):
    try:
        import quizloom
    except ModuleNotFoundError:
        yield from batches


# The folders come from the driver's own path only after its workers have been told theirs.
assert spark.range(3).mapInArrow(missing, "id long").count() == 3
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry

names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()] + ["pipeline"]
assert len(names) >= 14
for name in names:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_all_queries_run_on_workers_without_the_repository(tmp_path):
    (tmp_path / "job.py").write_text(SCRIPT)
    known = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "job.py"], cwd=tmp_path, env=known, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") >= 14
