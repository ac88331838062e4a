"""Words of many texts at once as 64-bit hashes, with numpy inside tasks.

A word is a run of bytes other than ASCII white space (space, \\t to \\r); A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # temporary arrays take about fifty times as much
SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_POW = _powers(np.uint64(0xD6E8FEB86659FD93), 256)
_STEP = _powers(np.uint64(0xA0761D6478BD642F), SHINGLE + 1)
_COUNT = np.arange(SHINGLE, dtype=np.uint64) * _BASE


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of rows of about CHUNK_BYTES; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, row, start, end) of each word, in order."""
    global _POW
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    solid = ~_SPACE[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    lengths = ends - starts
    if (longest := int(lengths.max())) > len(_POW):
        _POW = _powers(_POW[1], longest)
    at = np.flatnonzero(solid)
    first = np.cumsum(lengths) - lengths
    rel = np.arange(len(at)) - np.repeat(first, lengths)
    h = np.add.reduceat(_BYTE[data[at]] * _POW[rel], first)
    h = mix(h + lengths.astype(np.uint64) * _BASE)
    rows = np.searchsorted(offsets[: n + 1], starts, "right") - 1
    return h, rows, starts, ends


def shingles(h: np.ndarray, rows: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """Sorted distinct hashes of SHINGLE words in a row for each text; of fewer words, of them all."""
    counts = np.bincount(rows, minlength=n_rows) if len(rows) else np.zeros(n_rows, np.int64)
    ends = np.cumsum(counts)
    out = []
    if len(h) >= SHINGLE:
        acc = np.zeros(len(h) - SHINGLE + 1, np.uint64)
        for j in range(SHINGLE):
            acc += h[j : len(acc) + j] * _STEP[j]
        acc = mix(acc)
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(acc[end - n : end - SHINGLE + 1]))
        elif n:
            few = np.add.reduce(h[end - n : end] * _STEP[:n], keepdims=True) + _COUNT[n : n + 1]
            out.append(mix(few))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text in turn."""
    for _, data, offsets in chunks(texts):
        h, rows, _, _ = word_hashes(data, offsets)
        yield from shingles(h, rows, len(offsets) - 1)
