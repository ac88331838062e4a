"""Blocks of a group met pair by pair, and small graphs inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(df: DataFrame, size: Column, member: str, block: int) -> DataFrame:
    """Deal each group's members into blocks of about `block` and copy each to the pairs of its block.

    Two members of a group meet in the pair of their blocks (bi <= bj); a group of up to `block` is one
    pair. No task ever holds more than two blocks.
    """
    n = F.greatest(F.lit(1), F.ceil(size / F.lit(block))).cast("int")
    return (
        df.withColumn("_n", n)
        .withColumn("_b", F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("_n")).cast("int"))
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("bi", F.least("_b", "_o"))
        .withColumn("bj", F.greatest("_b", "_o"))
        .drop("_n", "_b", "_o")
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of whole groups of rows that are sorted by the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = _last_start(batch, keys)
        if cut == 0 and held and _same(held[-1], batch, keys):
            held.append(batch)
            continue
        if held and not _same(held[-1], batch, keys):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def bounds(table: pa.Table, keys: int) -> np.ndarray:
    """Row numbers at which groups start, and the number of rows."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for c in range(keys):
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), n)


def _last_start(batch: pa.RecordBatch, keys: int) -> int:
    return int(bounds(pa.Table.from_batches([batch]), keys)[-2])


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: int) -> bool:
    return all(a.column(c)[a.num_rows - 1] == b.column(c)[0] for c in range(keys))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True
