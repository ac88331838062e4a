"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact confirmation."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.components import components
from partura.llm.groups import Forest, block_pairs, bounds, grouped
from partura.llm.shipping import frugal, map_arrow
from partura.llm.storage import Workspace
from partura.llm.words import mix, shingle_sets

HASHES = 128
ROWS = 4  # hashes in a band
BATCH = 16  # hashes compared at a time
MISS = 1e-6  # a pair is pruned when its similarity is below the bound but for this probability
PERCENT = 75
BLOCK = 512
BROADCAST_IDS = 500_000

_A = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, 1001 + HASHES, dtype=np.uint64))


def _signature(s: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(s), 4096):
        np.minimum(least, (s[lo : lo + 4096] * _A[:, None] + _B[:, None]).min(axis=1), out=least)
    return least


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    band = np.arange(HASHES // ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    step = mix(np.arange(7, 7 + ROWS, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        counts, digests, bands, sigs = [], [], [], []
        for s in shingle_sets(batch.column(1)):
            counts.append(len(s))
            if not len(s):
                digests.append(None), bands.append(None), sigs.append(None)
                continue
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            sig = mix(_signature(s))
            keys = (sig.reshape(-1, ROWS) * step).sum(axis=1, dtype=np.uint64)
            bands.append(mix(keys + band).view(np.int64))
            sigs.append(sig.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(sigs, pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "bands", "sig"],
        )


@lru_cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each number of compared batches, the fewest equal hashes with which a pair goes on.

    With a uniform prior on the share p of equal hashes, P(p >= t | m of n equal) is
    P(Binomial(n + 1, t) <= m). Eight bits of a hash are equal by chance once in 256.
    """
    t = percent / 100 + (1 - percent / 100) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below > miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _survivors(sig: np.ndarray, need: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose similarity may reach the bound, after batches of signature hashes."""
    i, j = np.triu_indices(len(sig), 1)
    equal = np.zeros(len(i), np.int32)
    for k, least in enumerate(need):
        part = sig[:, k * BATCH : (k + 1) * BATCH]
        equal += (part[i] == part[j]).sum(axis=1, dtype=np.int32)
        keep = equal >= least
        if not keep.all():
            i, j, equal = i[keep], j[keep], equal[keep]
        if not len(i):
            break
    return i, j


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_LINKS)


def _verify(percent: int, miss: float):
    need = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            ids = table.column(3).to_numpy()
            sig = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(-1, HASHES)
            at, a, b = bounds(table, 3), [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                if hi - lo < 2:
                    continue
                own, forest = ids[lo:hi], Forest(hi - lo)
                for i, j in zip(*(x.tolist() for x in _survivors(sig[lo:hi], need))):
                    if forest.join(i, j):
                        a.append(int(own[i])), b.append(int(own[j]))
            yield _links(a, b)

    return run


def exact_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what all pairs with 100 * intersection >= percent * union connect."""
    m = len(sets)
    forest, out = Forest(m), []
    sizes = np.array([len(s) for s in sets])
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if both and 100 * both >= percent * (sizes.sum() - both) else []
    names, local = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    flag, left = np.zeros(len(names), np.int32), m - 1
    for i in range(m - 1):
        if not left:
            break
        others = np.array([j for j in range(i + 1, m) if forest.find(j) != forest.find(i)], np.int64)
        if not len(others):
            continue
        mine = local[starts[i] : starts[i] + sizes[i]]
        flag[mine] = 1
        if len(others) * 4 > m:
            both = np.add.reduceat(flag[local], starts)[others]
        else:
            both = np.array([flag[local[starts[j] : starts[j] + sizes[j]]].sum() for j in others.tolist()])
        flag[mine] = 0
        near = (both > 0) & (100 * both >= percent * (sizes[i] + sizes[others] - both))
        for j in others[near].tolist():
            if forest.join(i, j):
                out.append((i, j))
                left -= 1
    return out


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            table = table.combine_chunks()
            ids = table.column(3).to_numpy()
            sets = [s for c in table.column(4).chunks for s in shingle_sets(c)]
            at, a, b = bounds(table, 3), [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                # A doc_id of several rows may also have a text without words, which links with nothing.
                some = [k for k in range(lo, hi) if len(sets[k])]
                for i, j in exact_links([sets[k] for k in some], percent) if len(some) > 1 else ():
                    a.append(int(ids[some[i]])), b.append(int(ids[some[j]]))
            yield _links(a, b)

    return run


def _in_blocks(df: DataFrame, group: str, run) -> DataFrame:
    """Rows (group, bi, bj, id, payload) of a pair of blocks together, through `run`."""
    dealt = df.repartition(group, "bi", "bj").sortWithinPartitions(group, "bi", "bj")
    return map_arrow(dealt, frugal(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, miss: float = MISS, block: int = BLOCK, ws: Workspace | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `docs` (doc_id, text).

    Documents link when the Jaccard similarity of their sets of five-word shingles is at least
    `percent` / 100; a component is what links connect, named by its smallest doc_id, which is the row
    kept. The steps:

    1. Set digest, 32 band keys of 4 hashes and a signature of 128 bytes for each text, in one pass. Equal sets
       become one representative by a combined minimum.
    2. Band buckets of two or more representatives; of buckets with the same members one is kept.
    3. Inside a bucket, in pairs of blocks, signatures are compared 16 hashes at a time. A pair goes when the
       posterior probability that it reaches the bound is below `miss`. What survives is written as a spanning
       forest, never as all pairs; its components hold every link.
    4. Each component is confirmed on the full shingle sets, again in pairs of blocks, and what the exact
       links connect is the result.

    A pair at the bound shares no band with probability (1 - 0.75^4)^32 = 5e-6. Null or empty texts and texts of
    white space have an empty set and link with nothing. Rows with one doc_id are one document: they share its
    component. A row with a null doc_id gets its n_shingles, a null component_id and is kept. Other columns are
    ignored. An empty table gives no rows.
    """
    ws = ws or Workspace(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, digest binary, bands array<long>, sig binary"
    prints = ws.save(map_arrow(docs, frugal(_fingerprints), schema), "prints")
    known = prints.where("digest is not null and doc_id is not null")
    first = ws.save(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "first")
    reps = ws.save(
        known.join(first, (known.digest == first.digest) & (known.doc_id == first.rep), "left_semi")
        .dropDuplicates(["doc_id", "digest"])
        .select(F.col("doc_id").alias("rep"), "bands", "sig"),
        "reps",
    )
    keys = reps.select("rep", F.explode("bands").alias("bucket"))
    buckets = (
        keys.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("rep")).alias("x"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"),
        )
        .where("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n")
    )
    buckets = ws.save(buckets, "buckets")
    met = block_pairs(keys.join(buckets, "bucket"), F.col("n"), "rep", block).join(reps.select("rep", "sig"), "rep")
    coarse = _in_blocks(met.select("bucket", "bi", "bj", "rep", "sig"), "bucket", _verify(percent, miss))
    groups = components(ws, coarse, "coarse")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    members = ws.save(groups.join(sizes, "component"), "members")
    # Texts outside every group need not move when the list of those inside is small; beyond, a shuffle join.
    ids = F.broadcast(members) if members.count() <= BROADCAST_IDS else members
    texts = docs.join(ids, docs.doc_id == ids.node).dropDuplicates(["doc_id", "text"])
    dealt = block_pairs(texts, F.col("n"), "doc_id", block).select("component", "bi", "bj", "doc_id", "text")
    rep = prints.select("doc_id", "n_shingles", "digest").join(first, "digest", "left")
    # Rows with one doc_id and different sets, or none, are one document.
    several = rep.where("doc_id is not null").groupBy("doc_id")
    several = several.agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.count_if(F.col("rep").isNull()).alias("blank"))
    several = ws.save(several.where("a is not null and (a <> z or blank > 0)"), "several")
    own = F.broadcast(several) if several.count() <= BROADCAST_IDS else several
    same = rep.join(own.where("a <> z"), "doc_id").where("rep is not null").select("a", F.col("rep").alias("b"))
    if not several.where("blank > 0").isEmpty():
        rep = rep.join(own.select("doc_id", "a"), "doc_id", "left").withColumn("rep", F.coalesce("rep", "a")).drop("a")
    exact = components(ws, _in_blocks(dealt, "component", _confirm(percent)).union(same), "exact")
    ws.drop("reps", "buckets", "members", "coarse_components")
    named = rep.join(exact, rep.rep == exact.node, "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, miss: float = MISS, ws: Workspace | None = None) -> DataFrame:
    """`docs` (doc_id, text) with one row of each group of near duplicates.

    Of a component the rows of its smallest doc_id stay. Rows that repeat a doc_id, or a text without a doc_id, are one
    document, of which one row stays: the least by a hash of the text. So empty texts with different ids all stay. Rows of
    documents that have one row are not moved. An empty table gives no rows; all columns are kept.
    """
    ws = ws or Workspace(docs.sparkSession, "one")
    name = "_" * max(map(len, docs.columns)) + "key"
    # Texts without an id are named by a hash, beyond the ids that are in use.
    nameless = F.lit(1 << 62) + F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(1 << 62))
    keyed = docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), nameless))
    found = near_duplicates(keyed.select(F.col(name).alias("doc_id"), "text"), percent, miss, ws=ws)
    marks = found.groupBy(F.col("doc_id").alias(name)).agg(
        F.bool_or("kept").alias("_kept"), (F.count("*") > 1).alias("_several")
    )
    marks = ws.save(marks.where("_several or not _kept"), "marks")
    several = marks.where("_several and _kept")
    some = not several.isEmpty()
    few = marks.count() <= BROADCAST_IDS
    single = keyed.join(F.broadcast(marks) if few else marks, name, "left_anti").drop(name)
    if not some:
        return single
    repeated = keyed.join(F.broadcast(several) if few else several, name, "left_semi")
    least = F.min_by(F.struct(*docs.columns), F.xxhash64(F.col("text").cast("string"))).alias("_row")
    return single.unionByName(repeated.groupBy(name).agg(least).select("_row.*"))
