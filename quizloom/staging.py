"""Tables written to the cluster's shared folder to cut lineage."""

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tells equal rows of a staged table apart.
ROW = "_row"


@functools.cache
def _temporary_root() -> str:
    return tempfile.mkdtemp(prefix="quizloom-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder, but only in local mode:
    a machine-local folder is out of reach of the other machines of a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return _temporary_root()


def staging_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark writes to; one that isn't there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(folder, True)


# The tables that each open ``scratch`` block has staged.
_open: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged within the block when it ends.

    For steps that write their result themselves: nothing may read the staged tables later.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            removed(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with_row(df: DataFrame, name: str) -> DataFrame:
    """``staged`` with a ``ROW`` column that numbers the rows, with gaps.

    As the last sort column it lets Spark split any number of rows that are equal in
    the others; without it a range sort sends all copies of a row to one task.
    """
    return staged(df.withColumn(ROW, F.monotonically_increasing_id()), name)
