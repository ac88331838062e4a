"""Near-duplicate vectors: an exact range join in a metric space.

The metric is the angle between vectors. Pivots cut the vectors into cells, a vector's home being the cell of its
nearest pivot. If x lives in cell i and y lies within e of x, then angle(y, p_i) <= angle(x, p_i) + e, which is at most the
radius of cell i plus e, and at most y's own angle to its nearest pivot plus 2 e. So y is copied to just those cells, and
every cell joins what it holds independently. Of two cells only the lower one meets the other's vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.components import components
from partura.llm.groups import Forest, bounds, grouped
from partura.llm.shipping import map_arrow
from partura.llm.storage import Workspace
from partura.llm.words import mix

PIVOT_SAMPLE = 2000  # vectors among which pivots are sought
MAX_PIVOTS = 256
CELL = 4096  # vectors of a cell that one task holds; a larger cell is met in blocks
VISITORS = 16384
SLACK = 1e-7  # far above the rounding of an angle
SLICE = 1024
BROADCAST_CLASSES = 500_000

_HOMES = "rid long, vec_id long, dim int, unit binary, home int, angle double, digest binary"
_MEETINGS = "dim int, cell int, bi int, bj int, own boolean, rid long, unit binary, n long"


def _units(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision and of length 1; None if null, zero, or holding nulls or non-finite parts."""
    out: list[np.ndarray | None] = []
    for v in column:
        part = v.values
        if part is None or not len(part) or part.null_count:
            out.append(None)
            continue
        x = part.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append(x / math.sqrt(float(x @ x)))
    return out


def _angles(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ p.T, -1, 1))


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """n vectors far from each other: each next one is the farthest from those before."""
    picked = [0]
    near = vectors @ vectors[0]
    while len(picked) < min(n, len(vectors)):
        picked.append(int(near.argmin()))
        np.maximum(near, vectors @ vectors[picked[-1]], out=near)
    return vectors[picked]


def _digest(unit: np.ndarray) -> bytes:
    return hashlib.blake2b((unit + 0.0).tobytes(), digest_size=16).digest()  # no -0.0


def _home(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column(2))
            dims = [0 if u is None else len(u) for u in units]
            home, angle = [None] * len(units), [None] * len(units)
            for d in set(dims) - {0}:
                at = [k for k, own in enumerate(dims) if own == d]
                if d not in pivots:
                    for k in at:
                        home[k], angle[k] = 0, math.pi
                    continue
                a = _angles(np.array([units[k] for k in at]), pivots[d])
                for k, i, v in zip(at, a.argmin(axis=1).tolist(), a.min(axis=1).tolist()):
                    home[k], angle[k] = i, v
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(dims, pa.int32()),
                    pa.array([None if u is None else u.tobytes() for u in units], pa.binary()),
                    pa.array(home, pa.int32()),
                    pa.array(angle, pa.float64()),
                    pa.array([None if u is None else _digest(u) for u in units], pa.binary()),
                ],
                ["rid", "vec_id", "dim", "unit", "home", "angle", "digest"],
            )

    return run


def _meet(pivots: dict, cells: dict[tuple[int, int], tuple[float, int]], own_blocks: dict, reach: float, visitors: int):
    """A row for each pair of blocks in which a vector is met."""
    after: dict[tuple[int, int], int] = {}
    for d in {d for d, _ in cells}:
        total = 0
        for i in sorted((i for e, i in cells if e == d), reverse=True):
            after[d, i], total = total, total + cells[d, i][1]
    visit_blocks = {k: -(-n // visitors) for k, n in after.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, dims, homes = (batch.column(k).to_pylist() for k in (0, 2, 4))
            units, angles, sizes = (batch.column(k).to_pylist() for k in (3, 5, 7))
            spread = mix(np.array(rids, np.uint64) + np.uint64(1)).tolist() if rids else []
            rows: list[tuple] = []
            for rid, d, u, h, a, r, w in zip(rids, dims, units, homes, angles, spread, sizes):
                n, v = own_blocks[d, h], visit_blocks[d, h]
                b = r % n
                rows += [(d, h, min(b, o), max(b, o), True, rid, u, w) for o in range(n)]
                rows += [(d, h, b, n + o, True, rid, u, w) for o in range(v)]
                if h and d in pivots:
                    to = _angles(np.frombuffer(u)[None, :], pivots[d][:h])[0]
                    for i in np.flatnonzero(to <= a + 2 * reach).tolist():
                        if (d, i) in cells and to[i] <= cells[d, i][0] + reach:
                            n, v = own_blocks[d, i], visit_blocks[d, i]
                            rows += [(d, i, o, n + r % v, False, rid, u, w) for o in range(n)]
            for lo in range(0, len(rows), 10_000):
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.int64())
                names = ["dim", "cell", "bi", "bj", "own", "rid", "unit", "n"]
                columns = zip(*rows[lo : lo + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs of unit vectors with cosine >= the bound, decided in double precision."""
    rough = cosine - 1e-6 - 2.5e-7 * x.shape[1]
    i, j = np.nonzero(x.astype(np.float32) @ y.astype(np.float32).T >= rough)
    sure = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
    return i[sure], j[sure]


def _join(own_blocks: dict[tuple[int, int], int], cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 4):
            at = bounds(table, 4)
            dim, cell, bi, bj, own = (table.column(k).to_numpy() for k in range(5))
            rid, units, sizes = table.column(5).to_numpy(), table.column(6), table.column(7).to_numpy()
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                if hi - lo < 2:
                    continue
                x = np.frombuffer(b"".join(units.slice(lo, hi - lo).to_pylist())).reshape(hi - lo, -1)
                mine, ids = own[lo:hi], rid[lo:hi]
                if bi[lo] == bj[lo]:
                    left = right = np.arange(hi - lo)
                elif mine.all():
                    n = own_blocks[dim[lo], cell[lo]]
                    part = mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(n)
                    left, right = np.flatnonzero(part == bi[lo]), np.flatnonzero(part == bj[lo])
                else:
                    left, right = np.flatnonzero(mine), np.flatnonzero(~mine)
                yield from _found(x, ids, sizes[lo:hi], left, right, cosine)

    return run


def _found(x, ids, sizes, left, right, cosine) -> Iterator[pa.RecordBatch]:
    """Links of left with right: for each row how many vectors those it links with stand for, and pairs that connect
    what the links connect."""
    n, forest, a, b = np.zeros(len(ids), np.int64), Forest(len(ids)), [], []
    for lo in range(0, len(right), SLICE):
        some = right[lo : lo + SLICE]
        i, j = linked(x[left], x[some], cosine)
        i, j = left[i], some[j]
        if left is right:
            i, j = i[i < j], j[i < j]
        n += np.bincount(i, sizes[j], len(ids)).astype(np.int64) + np.bincount(j, sizes[i], len(ids)).astype(np.int64)
        for p, q in zip(i.tolist(), j.tolist()):
            if forest.join(p, q):
                a.append(int(ids[p])), b.append(int(ids[q]))
    some = np.flatnonzero(n)
    none = pa.nulls(len(a), pa.int64())
    names = ["a", "b", "n"]
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), none], names)
    counts = [pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some])]
    yield pa.RecordBatch.from_arrays(counts, names)


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, cell: int = CELL, visitors: int = VISITORS, ws: Workspace | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding).

    Two rows link when the cosine of their vectors is at least `cosine`. Vectors that are null, empty or zero or hold null
    or non-finite parts link with nothing, nor do vectors of different lengths. Every row counts as a vector of its own,
    also when ids or vectors repeat (vectors of one direction are compared once, for all of them); component_id is the smallest vec_id of the rows that links connect. A row with a null
    vec_id counts, and is named by the others of its component or null.

    Pivots are picked among at most PIVOT_SAMPLE vectors; that choice changes the work and not the result. At
    most MAX_PIVOTS pivots, and radius and size of each cell, reach the driver. What a task holds is bounded by `cell`
    and `visitors` whatever the size of a cell. Where vectors lie evenly in many dimensions the triangle inequality
    excludes little, and the work nears that of comparing all pairs of blocks.
    """
    spark = vectors.sparkSession
    ws = ws or Workspace(spark, "vectors")
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    numbers = "embedding" if kind in ("float", "double") else F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long"), numbers)
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(PIVOT_SAMPLE).select("rid", "vec_id", "embedding").toArrow()
    by_dim: dict[int, list[np.ndarray]] = {}
    for u in _units(sample.column("embedding").combine_chunks()) if sample.num_rows else []:
        if u is not None:
            by_dim.setdefault(len(u), []).append(u)
    count = max(1, min(MAX_PIVOTS, round(total / cell)))
    pivots = {d: choose_pivots(np.array(x), count) for d, x in by_dim.items()}
    homes = ws.save(map_arrow(rows, _home(pivots), _HOMES), "homes")
    # Equal directions are one class: its first row meets the others', and stands for n.
    known = homes.where("home is not null").groupBy("digest")
    several = known.agg(F.min("rid").alias("rep"), F.count("*").alias("n"), F.min("vec_id").alias("least")).where("n > 1")
    several = ws.save(several, "several")
    several = F.broadcast(several) if several.count() <= BROADCAST_CLASSES else several
    classed = homes.join(several, "digest", "left").withColumn("rep", F.coalesce("rep", "rid"))
    held = classed.where("home is not null and rid = rep")
    held = held.select("rid", "vec_id", "dim", "unit", "home", "angle", "digest", F.coalesce("n", F.lit(1)).alias("n"))
    found = held.groupBy("dim", "home").agg(F.max("angle").alias("r"), F.count("*").alias("n")).collect()
    cells = {(c["dim"], c["home"]): (c["r"] + SLACK, c["n"]) for c in found}
    reach = math.acos(min(1.0, cosine)) + SLACK
    own_blocks = {k: -(-n // cell) for k, (_, n) in cells.items()}
    met = map_arrow(held, _meet(pivots, cells, own_blocks, reach, visitors), _MEETINGS)
    key = ["dim", "cell", "bi", "bj"]
    dealt = met.repartition(*key).sortWithinPartitions(*key)
    links = ws.save(map_arrow(dealt, _join(own_blocks, cosine), "a long, b long, n long"), "links")
    n_links = links.where("n is not null").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n"))
    groups = components(ws, links.where("n is null").select("a", "b"), "vectors")
    own = classed.select("rep", "rid", F.coalesce("n", F.lit(1)).alias("size"), F.coalesce("least", "vec_id").alias("least"))
    owner = own.where("rid = rep").join(groups, own["rep"] == groups["node"])
    named = owner.groupBy("component").agg(F.min("least").alias("component_id"))
    member = groups.join(named, "component").select(F.col("node").alias("rep"), "component_id")
    sizes = F.coalesce("n", F.lit(1)).alias("size")
    out = classed.select("rep", "vec_id", sizes, F.coalesce("least", "vec_id").alias("least"))
    out = out.join(n_links.withColumnRenamed("rid", "rep").withColumnRenamed("n", "others"), "rep", "left")
    out = out.join(member, "rep", "left").select(
        "vec_id",
        (F.coalesce("others", F.lit(0)) + F.col("size") - 1).cast("long").alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
