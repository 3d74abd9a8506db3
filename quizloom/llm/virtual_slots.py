"""Sharding through fixed virtual slots.

A record's hash gives one of ``SLOTS`` slots, for ever. A small versioned table says
which shard owns each slot; its first version deals the slots out in turn. Rebalancing
adds up the bytes of each slot and writes the next version, in which some slots have
moved from heavy shards to light ones. Adding a shard writes a version in which slots
move to the new shard only. The map has ``SLOTS`` rows, whatever the data, so it is
edited on the driver and can be sent to every task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom.staging import staged, staging_path

SLOTS = 4096
MAP = "version int, slot int, shard int, bytes long, records long"


def slot_of(*columns: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record."""
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, slot: str, size: str, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and records of each slot: one partial aggregate, ``slots`` rows at most."""
    totals = records.groupBy(slot).agg(F.sum(size), F.count(F.lit(1))).collect()
    sizes, counts = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for at, n_bytes, n in totals:
        sizes[at], counts[at] = n_bytes, n
    return sizes, counts


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """The shard of each slot, dealt out in turn."""
    return np.arange(slots, dtype=np.int32) % shards


def rebalanced(owner: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """``owner`` with slots moved from the heaviest shard to the lightest, as long as that evens them out.

    Each move takes the slot that leaves the two closest; ties go to the first slot.
    """
    owner = owner.copy()
    loads = np.bincount(owner, sizes, shards)
    while True:
        heavy, light = int(loads.argmax()), int(loads.argmin())
        gap = loads[heavy] - loads[light]
        mine = np.flatnonzero((owner == heavy) & (sizes > 0) & (sizes < gap))
        if not len(mine):
            return owner
        slot = mine[np.abs(gap - 2 * sizes[mine]).argmin()]
        owner[slot] = light
        loads[heavy] -= sizes[slot]
        loads[light] += sizes[slot]


def grown(owner: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """``owner`` with one more shard, number ``shards``, which takes its share from the heaviest ones."""
    owner = owner.copy()
    loads = np.append(np.bincount(owner, sizes, shards), 0.0)
    share = sizes.sum() / (shards + 1)
    while True:
        heavy = int(loads[:shards].argmax())
        mine = np.flatnonzero((owner == heavy) & (sizes > 0) & (sizes <= share - loads[shards]))
        if not len(mine) or loads[heavy] <= share:
            return owner
        slot = mine[sizes[mine].argmax()]
        owner[slot] = shards
        loads[heavy] -= sizes[slot]
        loads[shards] += sizes[slot]


def store_map(
    spark: SparkSession, path: str, version: int, owner: np.ndarray, sizes: np.ndarray, records: np.ndarray
) -> None:
    """Write one version of the map; writing a version again replaces it."""
    values = zip(owner.tolist(), sizes.tolist(), records.tolist())
    rows = [(version, slot, *x) for slot, x in enumerate(values)]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version:06d}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version:06d}")


def shard_documents(
    docs: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    map_path: str | None = None,
) -> DataFrame:
    """A shard of nearly equal bytes, and a place in it, for each row.

    Columns: ``key``, ``size`` (UTF-8 bytes of the text and one more), ``text_crc32``,
    ``law`` ("bytes"), ``shard``, ``slot`` (the place within the shard, 0 to rows - 1),
    ``grown_shard`` (null), ``virtual_slot``. Versions 1 and 2 of the map, before and after
    rebalancing, are written to ``map_path``, by default a folder below the shared one.

    A null text counts as empty, with crc 0. A record is hashed by key and text, so null
    and repeated keys spread; repeated rows share a virtual slot but not a place. Shards
    may stay empty if there are few records. An empty table gives an empty table. Other
    columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    # Read once: what follows needs no text. A row's place is the same in each reading of the table.
    rows = staged(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("crc"),
            slot_of(F.col(key), F.col(text), slots=slots).alias("virtual_slot"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "records",
    )
    sizes, records = slot_sizes(rows, "virtual_slot", "size", slots)
    path = map_path or staging_path(spark, "slot-map")
    owner = first_map(shards, slots)
    store_map(spark, path, 1, owner, sizes, records)
    store_map(spark, path, 2, rebalanced(owner, sizes, shards), sizes, records)
    owners = read_map(spark, path, 2)
    # Rows of a slot are numbered by the part they were read in, so that no slot is sorted as a whole.
    in_shard = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    in_slot = Window.partitionBy("virtual_slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    in_part = Window.partitionBy("virtual_slot", "part").orderBy("place")
    before = F.coalesce(F.sum("records").over(in_shard), F.lit(0)).alias("before")
    firsts = owners.select(F.col("slot").alias("virtual_slot"), "shard", before)
    parts = (
        rows.groupBy("virtual_slot", "part")
        .agg(F.count(F.lit(1)).alias("records"))
        .select("virtual_slot", "part", F.coalesce(F.sum("records").over(in_slot), F.lit(0)).alias("earlier"))
        .join(firsts, "virtual_slot")
        .select("virtual_slot", "part", "shard", (F.col("before") + F.col("earlier")).alias("first"))
    )
    numbered = rows.withColumn("nth", F.row_number().over(in_part))
    return numbered.join(parts, ["virtual_slot", "part"]).select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def write_shards(docs: DataFrame, owners: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` with a folder for each shard, by one version of the map; a slot's rows go to one file."""
    owned = owners.select(F.col("slot").alias("_slot"), F.col("shard").alias("_shard"))
    slots = owners.count()
    placed = docs.withColumn("_slot", slot_of(F.col(key), F.col(text), slots=slots)).join(owned, "_slot")
    placed.repartition("_shard", "_slot").drop("_slot").write.partitionBy("_shard").parquet(path)
