"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_fold(key: Column, folds: int) -> Column:
    """Whether crc32 of the key's text is a multiple of ``folds``; a null key is in the fold."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def text_hash(text: str) -> Column:
    """With the key, tells documents apart also where keys are null or repeat."""
    return F.xxhash64(F.col(text).cast("binary"))


def parts_for(total: int, each: int, most: int | None = None) -> int:
    """How many parts of about ``each`` bytes hold ``total`` bytes."""
    parts = max(1, -(-total // each))
    return min(parts, most) if most else parts


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def unpacked(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def packed_ints(values: np.ndarray) -> bytes:
    """Non-negative numbers, mostly small, byte by byte."""
    wide = np.ascontiguousarray(values, np.int64)
    return packed(wide.view(np.uint8).reshape(-1, 8).T)


def unpacked_ints(data: bytes) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    """Sorted ``uint64`` keys as the bytes of their differences, byte by byte."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return packed(steps.view(np.uint8).reshape(-1, 8).T)


def unpacked_sorted(data: bytes) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[tuple]:
    """Rows of ``batches`` with their texts' bytes, about ``most`` bytes at a time.

    A single text may be longer; it is never cut.
    """
    for batch in batches:
        sizes = texts_sizes(batch.column(text))
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > most:
                part = batch.slice(start, i - start)
                yield part, texts_of(part.column(text))
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, texts_of(part.column(text))


def texts_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_numpy(zero_copy_only=False)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each run begins if runs of these lengths follow one another."""
    return np.cumsum(lengths) - lengths


def run_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``; runs may be empty."""
    ends = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    stops = np.cumsum(lengths)
    return ends[stops] - ends[stops - lengths]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group in turn, from batches sorted by ``keys`` (no nulls)."""
    held: list[pa.Table] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        first = tuple(c[0] for c in columns)
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        rows = pa.Table.from_batches([batch])
        for a, b in zip(starts, starts[1:]):
            if held and (a or first != before):
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
        before = tuple(c[-1] for c in columns)
    if held:
        yield pa.concat_tables(held)
