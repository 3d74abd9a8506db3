"""Near-duplicate vectors by Euclidean p-stable hashing.

A table projects the normalised vector on ``WIDTH_HASHES`` random normal directions,
shifts and cuts the projections into steps, and takes the steps together as a bucket.
Vectors that share a bucket in any table are compared exactly, in double precision, by
the first table in which they meet, so each pair counts once and no pair is written.

Equal vectors are one class with a count. A bucket larger than a block is compared block
by block, each pair of blocks a unit of its own, so no task holds more than two blocks;
a task hands on a count and a link to a component's first vector for each of its vectors.
Vectors that are alone in a bucket don't travel to it.

With 32 tables of 14 steps of width 2, a pair at cosine 0.93 meets with probability 0.97,
at 0.95 with 0.995, at 0.97 with 0.9999; unrelated pairs (right angle) with 0.0013.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import sorted_groups
from quizloom.llm.components import Forest, components
from quizloom.staging import staged

LEAST_COSINE = 0.93
TABLES = 32
STEPS = 14
WIDTH = 2.0
SEED = 17
#: Vectors compared with one another at once.
BLOCK = 2048


def projections(dim: int, tables: int, steps: int, width: float, seed: int):
    """Directions, shifts, and odd factors that mix a table's steps into one number."""
    random = np.random.default_rng((seed, dim))
    directions = random.standard_normal((dim, tables * steps))
    shifts = random.uniform(0, width, tables * steps)
    factors = random.integers(0, 1 << 63, tables * steps, np.uint64) | np.uint64(1)
    return directions, shifts, factors


def signatures(unit: np.ndarray, tables: int, steps: int, width: float, seed: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    directions, shifts, factors = projections(unit.shape[1], tables, steps, width, seed)
    at = np.floor((unit @ directions + shifts) / width).astype(np.int64).view(np.uint64)
    return (at * factors).reshape(len(unit), tables, steps).sum(axis=2, dtype=np.uint64).view(np.int64)


def signer(tables: int, steps: int, width: float, seed: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                vectors = batch.column("vector")
                sizes = np.diff(vectors.offsets.to_numpy())
                marks = np.empty((batch.num_rows, tables), np.int64)
                flat = vectors.flatten().to_numpy().astype(np.float64)
                ends = np.cumsum(sizes)
                for size in np.unique(sizes).tolist():
                    mine = np.flatnonzero(sizes == size)
                    found = flat[(ends[mine] - size)[:, None] + np.arange(size)]
                    unit = found / np.linalg.norm(found, axis=1, keepdims=True)
                    marks[mine] = signatures(unit, tables, steps, width, seed)
                offsets = pa.array(np.arange(len(marks) + 1) * tables, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in ("id", "label", "vector", "copies")],
                        pa.ListArray.from_arrays(offsets, pa.array(marks.ravel())),
                    ],
                    ["id", "label", "vector", "copies", "marks"],
                )

    return sign


def comparer(least: float, tables: int):
    """Blocks of buckets to (id, root, links): links newly met here, and the component's first id."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket", "low", "high"]):
            own, low, high, place = (group.column(n).to_numpy() for n in ("block", "low", "high", "place"))
            ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
            vectors = group.column("vector").combine_chunks()
            size = group.column("size")[0].as_py()
            values = vectors.flatten().to_numpy().astype(np.float64).reshape(-1, size)
            values /= np.linalg.norm(values, axis=1, keepdims=True)
            marks = group.column("marks").combine_chunks().flatten().to_numpy().reshape(-1, tables)
            one, other = np.flatnonzero(own == low), np.flatnonzero(own == high)
            a, b = np.nonzero(values[one] @ values[other].T >= least)
            a, b = one[a], other[b]
            once = a < b if low[0] == high[0] else np.ones(len(a), bool)
            a, b = a[once], b[once]
            # Met here, and in no earlier table.
            table = int(place[0])
            new = marks[a, table] == marks[b, table]
            for earlier in range(table):
                new &= marks[a, earlier] != marks[b, earlier]
            a, b = a[new], b[new]
            if not len(a):
                continue
            links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            forest = Forest(len(ids))
            forest.link(a, b)
            met = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[met]),
                    pa.array(ids[forest.root[met]]),
                    pa.array(links[met].astype(np.int64)),
                ],
                ["id", "root", "links"],
            )

    return compare


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
    tables: int = TABLES,
    steps: int = STEPS,
    width: float = WIDTH,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """Links of each row's vector: ``key`` (a long), ``n_links``, ``component_id``, ``kept``.

    Vectors link if their labels are equal, their lengths too, and their cosine is at
    least ``least``; ``n_links`` counts other rows, and ``component_id`` is the smallest
    key reachable. Rows with a null label, vector or key, a zero vector, or a null, NaN or
    infinite component link with nothing and are their own component; a null key has a
    null component and isn't kept. Rows that repeat a key and vector count as copies of
    it. An empty table gives an empty table; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    sound = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(
            F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0),
            F.lit(False),
        )
    )
    good = rows.where(sound)
    classes = staged(
        good.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    signed = staged(
        classes.select("id", "label", "vector", "copies").mapInArrow(
            signer(tables, steps, width, seed),
            f"id long, label {rows.schema['label'].dataType.simpleString()}, "
            f"vector {rows.schema['vector'].dataType.simpleString()}, copies long, marks array<long>",
        ),
        "signed-vectors",
    )
    met = signed.select("id", "label", F.size("vector").alias("size"), F.posexplode("marks").alias("place", "mark"))
    met = met.select("id", "size", "place", F.xxhash64("label", "size", "place", "mark").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    blocked = met.join(shared, "bucket").select(
        "id", "size", "place", "bucket", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"),
    )
    blocked = blocked.select(
        "id", "size", "place", "bucket", "block",
        F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = staged(
        blocked.join(signed.drop("label"), "id")
        .repartition(tasks, "bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(comparer(least, tables), "id long, root long, links long"),
        "near-vectors",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    result = (
        classes.join(links, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label", "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    linked = good.join(result, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(key), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
