"""Tables divided by linear hashing, that grow one bucket at a time.

A key's bucket is its hash modulo the number of buckets at the start of the level; buckets
below the split pointer have been split, and their keys take one more bit of the hash. So
the number of buckets follows the rows, and growing by one bucket rewrites one bucket.

Rows lie in parts, one for each step that wrote, as ``rows/part=<n>/bucket=<b>``. Which
parts of a bucket are live is written in the table's state (``quizloom.versions``): a step
writes a new part and then publishes a state that names it, and buckets with many parts are
brought together into one. Beside each part lies a Bloom filter of its keys.
"""

from __future__ import annotations

import copy
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.staging import removed
from quizloom.versions import subfolders

#: Buckets of an empty table, a power of two.
BASE = 8
ROWS_PER_BUCKET = 250_000
#: More parts of a bucket than this are brought together.
MOST_PARTS = 8
#: Bits of a filter for each key, and how many of them a key sets: about 1 % of other keys seem known.
FILTER_BITS = 10
PROBES = 4
#: Bits of one bitmap that Spark's aggregate makes.
SLOT = 32_768


def empty() -> dict:
    """The state of a table without rows."""
    return {"level": 0, "split": 0, "buckets": {}, "slots": {}}


def bucket_count(state: dict) -> int:
    return (BASE << state["level"]) + state["split"]


def total_rows(state: dict) -> int:
    return sum(b["rows"] for b in state["buckets"].values())


def with_buckets(state: dict, count: int) -> dict:
    """``state`` grown to ``count`` buckets, as a layout only: the rows don't move."""
    grown = copy.deepcopy(state)
    while bucket_count(grown) < count:
        grown["split"] += 1
        if grown["split"] == BASE << grown["level"]:
            grown["level"], grown["split"] = grown["level"] + 1, 0
    return grown


def bucket_of(state: dict, key: Column) -> Column:
    """The bucket that holds a key."""
    hashed, now = F.xxhash64(key), BASE << state["level"]
    before = F.pmod(hashed, F.lit(now))
    return F.when(before < state["split"], F.pmod(hashed, F.lit(2 * now))).otherwise(before).cast("int")


def read(
    spark: SparkSession, state: dict, root: str, schema: str, buckets: list[int] | None = None, after: int = 0
) -> DataFrame:
    """Live rows, of some buckets if given, and of parts later than ``after``; with ``part`` and ``bucket``."""
    wanted = state["buckets"] if buckets is None else [str(b) for b in buckets if str(b) in state["buckets"]]
    paths = [
        f"{root.rstrip('/')}/rows/part={part}/bucket={b}"
        for b in wanted
        for part in state["buckets"][b]["parts"]
        if part > after
    ]
    if not paths:
        return spark.createDataFrame([], f"{schema}, part int, bucket int")
    reader = spark.read.schema(f"{schema}, part int, bucket int").option("basePath", f"{root.rstrip('/')}/rows")
    return reader.parquet(*paths)


def _probe(key: list[Column], salt: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit(salt)), F.lit(slots * SLOT))


def write_part(rows: DataFrame, root: str, part: int, keys: list[str] | None = None) -> tuple[dict[str, int], int]:
    """Write ``rows`` (with ``bucket``) as a part; the rows of each bucket, and the slots of its filter.

    A part that no state names yet is replaced. Few files: a bucket's rows come together,
    but for those of a bucket too large for one task.
    """
    spark, path = rows.sparkSession, f"{root.rstrip('/')}/rows/part={part}"
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    if not subfolders(spark, path):
        return {}, 0
    written = spark.read.parquet(path)
    counts = {str(r["bucket"]): r["count"] for r in written.groupBy("bucket").count().collect()}
    if not keys or not counts:
        return counts, 0
    slots = -(-FILTER_BITS * max(counts.values()) // SLOT)
    probes = F.explode(F.array(*[_probe([F.col(k) for k in keys], i, slots) for i in range(PROBES)]))
    bits = written.select("bucket", probes.alias("bit"))
    # Numbered from 0; the functions count from bit 1 and slot 1.
    filters = bits.groupBy("bucket", F.floor(F.col("bit") / SLOT).cast("int").alias("slot")).agg(
        F.bitmap_construct_agg(F.pmod("bit", F.lit(SLOT))).alias("bits")
    )
    filters.write.mode("overwrite").parquet(f"{root.rstrip('/')}/filters/part={part}")
    return counts, slots


def added(state: dict, counts: dict[str, int], part: int, slots: int) -> dict:
    """``state`` with a written part."""
    state = copy.deepcopy(state)
    for bucket, rows in counts.items():
        known = state["buckets"].setdefault(bucket, {"parts": [], "rows": 0})
        known["parts"].append(part)
        known["rows"] += rows
    if slots:
        state["slots"][str(part)] = slots
    return state


def maybe_known(spark: SparkSession, state: dict, root: str, rows: DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    """Which live (part, bucket) may hold a key of ``rows`` (with ``bucket``), by the filters.

    Reads no key of the table. A filter errs to one side: what it doesn't name holds none
    of the keys.
    """
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
    live = [
        (part, b, state["slots"][str(part)])
        for b in touched
        for part in state["buckets"].get(str(b), {"parts": []})["parts"]
    ]
    if not live:
        return []
    names = [f"{root.rstrip('/')}/filters/part={p}" for p in sorted({p for p, _, _ in live})]
    filters = spark.read.option("basePath", f"{root.rstrip('/')}/filters").parquet(*names)
    parts = F.broadcast(spark.createDataFrame(live, "part int, bucket int, slots int"))  # bounded by the state
    probe = lambda i: F.pmod(F.xxhash64(*keys, F.lit(i)), F.col("slots") * F.lit(SLOT))
    asked = rows.join(parts, "bucket").select(
        "part", "bucket", F.xxhash64(*keys).alias("key"), F.explode(F.array(*[probe(i) for i in range(PROBES)])).alias("bit")
    )
    asked = asked.withColumn("slot", F.floor(F.col("bit") / SLOT).cast("int"))
    at = F.pmod("bit", F.lit(SLOT)).cast("int")
    # Bit n of a bitmap is bit n % 8, from the lowest, of its byte n / 8; a bitmap without a bit isn't there.
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))
    met = asked.join(filters, ["part", "bucket", "slot"], "left")
    known = met.groupBy("part", "bucket", "key").agg(F.bool_and(is_set).alias("all")).where("all")
    return sorted((r["part"], r["bucket"]) for r in known.select("part", "bucket").distinct().collect())


def of_parts(state: dict, held: list[tuple[int, int]]) -> dict:
    """``state`` with nothing live but these (part, bucket)."""
    kept = copy.deepcopy(state)
    kept["buckets"] = {}
    for part, bucket in held:
        kept["buckets"].setdefault(str(bucket), {"parts": [], "rows": 0})["parts"].append(part)
    return kept


def arranged(
    spark: SparkSession,
    state: dict,
    root: str,
    schema: str,
    key: str,
    part: int,
    filter_keys: list[str] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    most_parts: int = MOST_PARTS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> dict:
    """``state`` after splitting buckets while they are too full on average, and bringing parts together.

    What changes is rewritten as ``part``, in one job, without the rows that ``keep`` leaves
    out; other buckets are not read. Publishing the state is up to the caller; until then
    the old one holds.
    """
    grown = with_buckets(state, -(-total_rows(state) // rows_per_bucket))
    moved = set()
    for b in range(bucket_count(state), bucket_count(grown)):
        # A bucket's rows come from the one whose number lacks its highest bit, maybe in several steps.
        while b >= bucket_count(state):
            b ^= 1 << b.bit_length() - 1
        moved.add(b)
    crowded = {int(b) for b, known in state["buckets"].items() if len(known["parts"]) > most_parts}
    rewritten = sorted(b for b in moved | crowded if str(b) in state["buckets"])
    if not rewritten:
        return grown
    rows = read(spark, state, root, schema, rewritten).drop("part", "bucket")
    rows = keep(rows) if keep else rows
    counts, slots = write_part(rows.withColumn("bucket", bucket_of(grown, F.col(key))), root, part, filter_keys)
    for b in rewritten:
        del grown["buckets"][str(b)]
    grown = added(grown, counts, part, slots)
    live = {str(p) for known in grown["buckets"].values() for p in known["parts"]}
    grown["slots"] = {p: n for p, n in grown["slots"].items() if p in live}
    return grown


def drop_unnamed(spark: SparkSession, state: dict, root: str) -> None:
    """Delete what ``state`` doesn't name. No reader may be at work on an older state, and no writer."""
    live = {(p, int(b)) for b, known in state["buckets"].items() for p in known["parts"]}
    for folder in subfolders(spark, f"{root.rstrip('/')}/rows"):
        part = int(folder.removeprefix("part="))
        names = subfolders(spark, f"{root.rstrip('/')}/rows/{folder}")
        kept = [n for n in names if (part, int(n.removeprefix("bucket="))) in live]
        for name in set(names) - set(kept):
            removed(spark, f"{root.rstrip('/')}/rows/{folder}/{name}")
        if not kept:
            removed(spark, f"{root.rstrip('/')}/rows/{folder}")
            removed(spark, f"{root.rstrip('/')}/filters/{folder}")
