"""Leaving out rows whose key is surely not in a set, at a fixed broadcast size.

The set is a field of 2 ** BITS bits, one set by the hash of each key, as words of 64 bits. However
many keys there are, the field has at most 2 ** (BITS - 6) words, so it may always be broadcast. A
key whose bit is set by another one passes; who needs the exact set checks again what passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def _place(key: str, bits: int) -> str:
    return f"pmod(xxhash64({key}), {1 << bits}L)"


def field_of(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Words (``word``, ``mask``) of the keys of a table; combined where the rows lie."""
    place = _place(key, bits)
    return (
        keys.filter(f"{key} IS NOT NULL")
        .selectExpr(f"{place} DIV 64 AS word", f"shiftleft(1L, CAST({place} % 64 AS INT)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
    )


def maybe_in(df: DataFrame, key: str, field: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key may be in the set; those without a key are not."""
    place = _place(key, bits)
    return (
        df.withColumn("word", F.expr(f"{place} DIV 64"))
        .join(F.broadcast(field), "word")
        .filter(f"mask & shiftleft(1L, CAST({place} % 64 AS INT)) <> 0")
        .select(*df.columns)
    )
