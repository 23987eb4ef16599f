"""Vectorised text primitives on Arrow batches: words, rolling hashes, packed rows. Pure numpy, no state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Odd multipliers of the polynomial hashes; the second, modulo 2**32, serves where two independent hashes are wanted.
M = 0x9E3779B97F4A7C15 | 1
M2 = 0x27D4EB4F
Q = 0xD6E8FEB86659FD93
#: Bytes of text that workers turn into Python objects at once.
PIECE = 1 << 20
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(n: int, base: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, modulo the kind's size; kept per worker for the usual batch size."""
    out = []
    for up in (True, False):
        have = _POWERS.get((base, up))
        if have is None or len(have) < n:
            p = np.full(max(n, 1 << 16), base if up else pow(base, -1, 1 << 8 * np.dtype(kind).itemsize), kind)
            p[0] = 1
            have = _POWERS[base, up] = np.cumprod(p, dtype=kind, out=p)
        out.append(have[:n])
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that low and high bits depend on all of them."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, concatenated, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[off[0] : off[-1]], off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about `most` bytes of text, so that temporaries stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = (np.cumsum(n) - n) // most
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield batch.slice(i, j - i)


def word_spans(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first-word-of-row offsets of the words: runs of bytes other than 0x20 and 0x09-0x0D."""
    n = len(b)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[off] = True  # a word never crosses from one row to the next
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)


def span_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = M, kind: type = U) -> np.ndarray:
    """A 64-bit hash of each byte span b[s:e], the same wherever the span stands; with M2 and uint32 another one, of 32
    bits of the span."""
    if not len(s):
        return np.zeros(0, U)
    up, down = powers(len(b), base, kind)
    c = np.zeros(len(b) + 1, kind)
    np.cumsum((b.astype(kind) + kind(1)) * up, out=c[1:])
    return mix(((c[e] - c[s]) * down[s] + (e - s).astype(kind)).astype(U, copy=False))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive items, at the run's first item (callers mask runs that cross rows)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = h[:n].copy()
    q = 1
    for i in range(1, k):
        q = q * Q % (1 << 64)
        out += h[i : i + n] * U(q)
    return mix(out)


def row_of(first: np.ndarray, n: int) -> np.ndarray:
    """The row of each of n items, when row r has the items from first[r] to first[r + 1]."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first)) if n else np.zeros(0, np.int64)


def inside(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the windows of k items, by first item, lie in one row."""
    if n < k:
        return np.zeros(0, bool)
    left = np.repeat(first[1:], np.diff(first))[: n - k + 1]
    return np.arange(n - k + 1) + k <= left


def binary_rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose row r holds the bytes of the next lengths[r] of `values`."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    off *= values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    data = np.ascontiguousarray(values)
    if off[-1] >= 1 << 31:
        raise ValueError("more than 2 GB in one packed batch")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)])


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def member(x: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    p = np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)
    return sorted_set[p] == x
