"""Intermediate tables in the shared folder, and groups of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores in front until no column of ``df`` begins with it (Spark's names ignore case)."""
    while any(c.lower().startswith(stem.lower()) for c in df.columns):
        stem = f"_{stem}"
    return stem


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """Inner join with ``right`` (one row a key) that no key of very many left rows slows down.

    ``hot`` picks the rows of ``right`` whose keys may be that frequent; the caller bounds their number, so they
    are broadcast. All other rows are shuffled by key. ``left`` is read twice.
    """
    often = F.broadcast(right.filter(hot))
    rare = left.join(F.broadcast(right.filter(hot).select(*on)), on, "left_anti").join(right.filter(~hot), on)
    return left.join(often, on).unionByName(rare)


def key_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, bounds) with whole groups only, from batches sorted by the long column ``key``.

    Group g is rows bounds[g] to bounds[g + 1]. Rows of a group that spans
    batches are kept together, so memory is one batch plus one group.
    """
    held: list[pa.RecordBatch] = []

    def whole(parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        k = table.column(key).to_numpy()
        return table, np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))

    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], "left"))  # the last group of the batch may go on
        if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != k[0]:
            yield whole(held)
            held = []
        if cut:
            yield whole([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield whole(held)


def matrix(column: pa.ChunkedArray | pa.Array, dtype: str, width: int) -> np.ndarray:
    """A binary column of equal-length values as a (rows, width) array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width), dtype)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[int(at[0]): int(at[-1])].view(dtype).reshape(-1, width)


class Union:
    """Disjoint sets over 0..n-1 (the smallest member is the root)."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
