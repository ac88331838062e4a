"""Packing of documents into sequences: shortest pack first over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partura.llm.shipping import frugal, map_arrow
from partura.llm.storage import Workspace
from partura.llm.tokens import encoder

LENGTH = 4096
PIECE = 4096
END = 2
RANKS = 2000  # rows that are numbered in one window group

_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, row long"


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packing patterns and how many sequences have each.

    Lengths are placed longest first. A piece goes to the open pack that holds least, if it fits there, else to a
    new one. Packs of one pattern are handled together by their count, so the work follows the number of distinct
    lengths and patterns and not the number of pieces.
    """
    open_packs: dict[int, list[list]] = {}  # by what a pack holds: [pattern, count]
    levels = set()

    def put(used: int, pattern: tuple, n: int) -> None:
        open_packs.setdefault(used, []).append([pattern, n])
        levels.add(used)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            used = min(levels, default=capacity)
            if used + length > capacity:
                each = min(capacity // length, left)
                n, rest = divmod(left, each)
                put(each * length, ((length, each),), n)
                left = rest
                continue
            groups = open_packs[used]
            pattern, n = groups.pop()
            if not groups:
                del open_packs[used]
                levels.discard(used)
            take = min(n, left)
            if take < n:
                put(used, pattern, n - take)
            if pattern[-1][0] == length:
                new = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                new = (*pattern, (length, 1))
            put(used + length, new, take)
            left -= take
    return [(pattern, n) for groups in open_packs.values() for pattern, n in groups]


def _cut(path: str, end: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        rows = 0
        for batch in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                ids = np.append(ids.astype("<u4"), np.uint32(end))
                for lo in range(0, len(ids), piece):
                    part = ids[lo : lo + piece]
                    doc.append(doc_id), start.append(lo), length.append(len(part)), total.append(len(ids))
                    crc.append(zlib.crc32(part.tobytes()))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = (doc, start, length, crc, total, range(rows, rows + len(doc)))
            rows += len(doc)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _slots(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> tuple[np.ndarray, ...]:
    """Where pieces go: sorted (length, first rank) keys, and sequence and offset of that rank."""
    taken: dict[int, int] = {}
    keys, firsts, sequences, offsets = [], [], [], []
    base = 0
    for pattern, n in patterns:
        offset = 0
        for length, times in pattern:
            for _ in range(times):
                rank = taken.get(length, 0)
                keys.append(length), firsts.append(rank), sequences.append(base), offsets.append(offset)
                taken[length] = rank + n
                offset += length
        base += n
    order = np.lexsort((firsts, keys))
    return tuple(np.array(x, np.int64)[order] for x in (keys, firsts, sequences, offsets))


_PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _placed(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, sequences, offsets = slots.value
        ends = np.searchsorted(keys, np.arange(int(keys[-1]) + 2)) if len(keys) else None
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(2).to_numpy().astype(np.int64)
            rank = batch.column(5).to_numpy().astype(np.int64)
            at = np.empty(len(rank), np.int64)
            for own in np.unique(length).tolist():
                rows = np.flatnonzero(length == own)
                lo, hi = ends[own], ends[own + 1]
                at[rows] = lo + np.searchsorted(firsts[lo:hi], rank[rows], "right") - 1
            columns = [*batch.columns[:2], pa.array(length), *batch.columns[3:5]]
            columns += [pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = LENGTH,
    piece: int = PIECE,
    end: int = END,
    ws: Workspace | None = None,
) -> DataFrame:
    """One row per piece of a document of `docs` (doc_id, text): where it lies in which sequence.

    A document is its token ids without special tokens, then `end`; null or empty text is `end` alone. Ids are cut into
    pieces of at most `piece`, so a longer document is cut and a shorter one stays whole. The histogram of piece lengths, at most `piece` numbers, goes to the driver,
    which finds the patterns; their slots go back as a broadcast, which depends on the lengths that occur and not on how many
    pieces there are. Pieces are numbered within their length in windows of about RANKS rows, and number
    and length give the slot. Repeated rows and rows without a doc_id are packed like others. An empty table
    gives no rows. Columns beyond doc_id and text are ignored.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "packing")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = ws.save(map_arrow(texts, frugal(_cut(vocabulary, end, piece)), _PIECES), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(shortest_pack_first(counts, length)))
    salts = [-(-counts.get(k, 0) // RANKS) or 1 for k in range(piece + 1)]
    table = F.array(*[F.lit(n) for n in salts])
    own = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "row"), F.get(table, F.col("length"))))
    cells = own.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = own.withColumn("r", F.row_number().over(within)).join(cells, ["length", "salt"])
    ranked = ranked.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("r") - 1).alias("rank")
    )
    return map_arrow(ranked, _placed(slots), _PACKED)
