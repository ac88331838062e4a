"""Whitening of vectors by exact integer scatter.

Entries become integers. A task packs each dimension's bits, plane by plane, across its rows into 64-bit words; the
number of rows in which two planes both have a bit is the popcount of their AND, and these, weighted by the planes' powers
of two, are exact cross-products. They are added as whole numbers and centred as whole numbers; floating point begins
with the covariance.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.shipping import map_arrow

STEPS = 64  # integer steps of 1
SHIFT = 1_000_000
COMPONENTS = 32
ROWS = 16_384  # rows whose bits are packed at a time
PLANES = 64  # planes that are met with all planes at a time
LIMB = 30  # bits by which sums are cut where they leave a task
_LARGEST = float(1 << 62) / STEPS

_MOMENTS = "dim int, a int, b int, limb int, value long"
_WHITE = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whole_entries(column: pa.Array) -> list[np.ndarray | None]:
    """Entries as floor(STEPS * c) + SHIFT; None for a vector that is null, empty or holds what no whole number stands for."""
    out: list[np.ndarray | None] = []
    for v in column:
        part = v.values
        if part is None or not len(part) or part.null_count:
            out.append(None)
            continue
        c = part.to_numpy(zero_copy_only=False).astype(np.float64)
        fine = np.isfinite(c).all() and float(np.abs(c).max()) < _LARGEST
        out.append(np.floor(STEPS * c).astype(np.int64) + SHIFT if fine else None)
    return out


def _by_dim(rows: list[np.ndarray | None]) -> dict[int, np.ndarray]:
    """Row numbers of the vectors of each length."""
    found: dict[int, list[int]] = {}
    for k, x in enumerate(rows):
        if x is not None:
            found.setdefault(len(x), []).append(k)
    return {d: np.array(at) for d, at in found.items()}


def bit_planes(y: np.ndarray) -> np.ndarray:
    """Planes (dimension, bit, word) of an unsigned matrix (row, dimension): 64 rows to a word, padded by zeros."""
    n, d = y.shape
    bits = max(1, int(y.max()).bit_length()) if n else 1
    words = -(-n // 64)
    padded = np.zeros((words * 64, d), np.uint64)
    padded[:n] = y
    out = np.empty((d, bits, words), np.uint64)
    for k in range(bits):
        plane = ((padded >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)
        out[:, k] = np.packbits(plane.T.copy(), axis=1, bitorder="little").view("<u8")
    return out


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of an integer matrix (row, dimension), as Python integers, by AND and popcount."""
    n, d = x.shape
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # wraps, so any two longs are told apart
    planes = bit_planes(y)
    bits = planes.shape[1]
    flat = planes.reshape(d * bits, -1)
    weight = [1 << k for k in range(2 * bits - 1)]
    sums = np.array([sum(int(c) << k for k, c in enumerate(row)) for row in np.bitwise_count(planes).sum(axis=2, dtype=np.int64)], object)
    cross = np.zeros((d, d), object)
    step = max(1, PLANES // bits)
    for lo in range(0, d, step):
        hi = min(d, lo + step)
        some = flat[lo * bits : hi * bits]
        counts = np.zeros((len(some), d * bits - lo * bits), np.int64)
        for w in range(0, flat.shape[1], 16):
            both = some[:, None, w : w + 16] & flat[None, lo * bits :, w : w + 16]
            counts += np.bitwise_count(both).sum(axis=2, dtype=np.int64)
        counts = counts.reshape(hi - lo, bits, d - lo, bits)
        by_weight = [
            sum(counts[:, k, :, t - k] for k in range(max(0, t - bits + 1), min(bits, t + 1))) for t in range(2 * bits - 1)
        ]
        if n.bit_length() + 2 * bits < 62:
            found = sum(c << t for t, c in enumerate(by_weight)).astype(object)
        else:
            found = sum(c.astype(object) * weight[t] for t, c in enumerate(by_weight))
        cross[lo:hi, lo:] = found
        cross[lo:, lo:hi] = found.T
    base = np.array([int(v) for v in low], object)
    whole = sums + n * base
    return whole, cross + np.outer(base, sums) + np.outer(sums, base) + n * np.outer(base, base)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A signed integer as digits of LIMB bits, of which no sum over tasks can be lost."""
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        digit = value & ((1 << LIMB) - 1)
        if digit:
            yield k, sign * digit
        value >>= LIMB
        k += 1


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows (a = b = -1), sums (b = -1) and cross-products (a <= b) by number of dimensions, relative to SHIFT."""
    total: dict[int, list] = {}

    def add(x: np.ndarray) -> None:
        n, d = x.shape
        sums, cross = cross_products(x - SHIFT)
        held = total.setdefault(d, [0, 0, 0])
        held[0], held[1], held[2] = held[0] + n, held[1] + sums, held[2] + cross

    waiting: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        rows = whole_entries(batch.column(0))
        for d, at in _by_dim(rows).items():
            waiting.setdefault(d, []).extend(rows[k] for k in at.tolist())
            while len(waiting[d]) >= ROWS:
                add(np.array(waiting[d][:ROWS]))
                waiting[d] = waiting[d][ROWS:]
    for d, rest in waiting.items():
        if rest:
            add(np.array(rest))
    for d, (n, sums, cross) in total.items():
        out = [(-1, -1, *part) for part in _limbs(n)]
        out += [(a, -1, *part) for a in range(d) for part in _limbs(int(sums[a]))]
        out += [(a, b, *part) for a in range(d) for b in range(a, d) for part in _limbs(int(cross[a, b]))]
        for lo in range(0, len(out), 50_000):
            a, b, limb, value = zip(*out[lo : lo + 50_000])
            columns = [pa.array([d] * len(a), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32())]
            columns += [pa.array(limb, pa.int32()), pa.array(value, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "a", "b", "limb", "value"])


class Fit:
    """Exact moments of vectors of one length, and the projection that whitens them."""

    def __init__(self, dim: int, n: int, sums: list[int], cross: dict[tuple[int, int], int], components: int):
        self.dim, self.n, self.sums = dim, n, sums  # sums are relative to SHIFT
        v = np.empty((dim, dim))
        for a in range(dim):
            for b in range(a, dim):
                # n * cross - S_a S_b is the centred scatter times n, a whole number; one rounding follows.
                v[a, b] = v[b, a] = (n * cross.get((a, b), 0) - sums[a] * sums[b]) / (n * n)
        trace = float(Fraction(sum(n * cross.get((a, a), 0) - sums[a] ** 2 for a in range(dim)), n * n))
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        values, vectors = values[order], vectors[:, order]
        # Beyond the rank of the data eigenvalues are rounding errors.
        self.varies = values > max(float(values.max(initial=0.0)), 0.0) * dim * 1e-13
        self.explained = np.where(self.varies, values, 0.0) / trace if trace > 0 else np.zeros(len(values))
        self.weights = np.where(self.varies, vectors / np.sqrt(np.where(self.varies, values, 1.0)), 0.0)
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Of vectors as whole numbers: sum over dimensions of (n x - S)^2, and x - S / n."""
        n, x = self.n, x - SHIFT
        far = n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if far.bit_length() * 2 + self.dim.bit_length() < 63:
            off = n * x - np.array(self.sums, np.int64)
            return (off * off).sum(axis=1).tolist(), off / n
        off = n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (off * off).sum(axis=1)], (off / n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        deviation, off = self.centred(x)
        return deviation, off @ self.weights


def _chunks(batch: pa.RecordBatch, fits: dict[int, Fit]) -> Iterator[tuple[np.ndarray, Fit, list[int], np.ndarray]]:
    rows = whole_entries(batch.column(batch.schema.get_field_index("embedding")))
    for d, at in _by_dim(rows).items():
        for lo in range(0, len(at), 4096):
            some = at[lo : lo + 4096]
            yield some, fits[d], *fits[d].whitened(np.array([rows[k] for k in some.tolist()]))


def _checked(fits):
    """Sums and cross-products of whitened rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, fit, _, z in _chunks(batch, fits.value):
                z = np.column_stack([z, np.ones(len(z))])
                total[fit.dim] = total.get(fit.dim, 0) + z.T @ z
        out = [(d, a, b, float(t[a, b])) for d, t in total.items() for a in range(len(t)) for b in range(a, len(t))]
        if out:
            d, a, b, value = zip(*out)
            columns = [pa.array(c, pa.int32()) for c in (d, a, b)] + [pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "a", "b", "value"])

    return run


def _rows(fits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, fit, deviation, z in _chunks(batch, fits.value):
                k, m = z.shape[1], len(at)
                first = np.repeat(np.arange(m), k)
                columns = [
                    ids.take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fit.n, np.int64)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(first)),
                    pa.array(z.ravel()),
                    pa.array(np.tile(fit.explained, m)),
                    pa.array(np.full(m * k, fit.identity_error)),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The projection for each length of vector in `vectors` (embedding), from all of them.

    What reaches the driver is the square of the number of dimensions, however many vectors there are.
    """
    moments = map_arrow(vectors.select("embedding"), _moments, _MOMENTS)
    added = moments.groupBy("dim", "a", "b", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    held: dict[int, dict[tuple[int, int], int]] = {}
    for row in added.toLocalIterator():
        cells = held.setdefault(row["dim"], {})
        at = (row["a"], row["b"])
        cells[at] = cells.get(at, 0) + (int(row["value"]) << (LIMB * row["limb"]))
    fits = {}
    for d, cells in held.items():
        sums = [cells.get((a, -1), 0) for a in range(d)]
        fits[d] = Fit(d, cells[-1, -1], sums, cells, components)
    return fits


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): `vectors` (vec_id, embedding) on their main axes.

    Vectors that are null or empty or hold null or non-finite entries, or entries of 2^56 and more, are dropped; all others
    are fitted and returned. Entry c counts as x = floor(64 c) + 1000000, n is the number of vectors, S the sums of x;
    deviation is the sum of (n x - S)^2 over dimensions, exact. Components go by falling eigenvalue e of the covariance of x
    (divisor n), up to `components`; whitened is x - S / n on the unit eigenvector over sqrt(e), and explained is e / trace.
    identity_error is the largest entry of the whitened rows' covariance minus the identity, as measured over all rows.

    Where data vary in fewer directions than there are components, the others have whitened 0 and explained 0, and
    identity_error covers those that vary. Equal eigenvalues leave the choice of axes open. Vectors of another length are a fit
    of their own. Rows may repeat, also with one vec_id or none; each counts. An empty table gives no rows. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    numbers = "embedding" if kind in ("float", "double") else F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), numbers)
    fits = fit(rows, components)
    shared = spark.sparkContext.broadcast(fits)
    checks = map_arrow(rows, _checked(shared), "dim int, a int, b int, value double")
    found = checks.groupBy("dim", "a", "b").agg(F.sum("value").alias("value")).collect()
    for d, own in fits.items():
        k = own.weights.shape[1]
        total = np.zeros((k + 1, k + 1))
        for row in (r for r in found if r["dim"] == d):
            total[row["a"], row["b"]] = total[row["b"], row["a"]] = row["value"]
        mean = total[:k, k] / own.n
        error = np.abs(total[:k, :k] / own.n - np.outer(mean, mean) - np.eye(k))
        some = np.ix_(own.varies, own.varies)
        own.identity_error = float(error[some].max(initial=0.0))
    shared = spark.sparkContext.broadcast(fits)
    return map_arrow(rows, _rows(shared), _WHITE)
