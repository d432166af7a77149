"""Vectorised word hashing over Arrow string columns (numpy, used inside tasks).

Texts stay UTF-8 bytes.  All separators used here are ASCII, so words can be cut
byte-wise; a word's 64-bit hash is a polynomial over its lower-cased (A-Z only)
bytes, read off prefix sums, then mixed.  Work goes in slices of a few MB, so a
task's memory does not depend on the batch or on the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2 ** 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes inside words: everything but white space; letters, digits and non-ASCII only.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True  # after lower-casing

_pow = np.ones(1, dtype=U)
_inv = np.ones(1, dtype=U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the hash's powers; those a slice needs are kept, longer ones (one long word) only while in use."""
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, SLICE_BYTES + 1024)
        f = np.full(size, _BASE, dtype=U)
        f[0] = 1
        g = np.full(size, _INV, dtype=U)
        g[0] = 1
        f, g = np.cumprod(f), np.cumprod(g)
        if size > 2 * SLICE_BYTES:
            return f[:n], g[:n]
        _pow, _inv = f, g
    return _pow[:n], _inv[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets.astype(np.int64)


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into (lo, hi, bytes, offsets from 0) of about ``max_bytes`` each; a longer text is a
    slice of its own."""
    if not len(column):
        return
    raw, off = string_buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts of a slice: (hash, start, end, words per text); no word spans two texts."""
    low = LOWER[raw]
    n = len(low)
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(U), z, z, counts
    w = inside[low]
    edge = offsets[1:-1]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = w[:-1]
    before[edge[edge < n]] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(w & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return span_hashes(low, starts, ends), starts, ends, counts


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``low[starts:ends]`` (ascending, not overlapping)."""
    out = np.empty(len(starts), dtype=U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES)))
        lo, hi = starts[i], ends[j - 1]
        p, q = _powers(hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=U)
        np.cumsum((low[lo:hi].astype(U) + U(1)) * p, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * q[s])
        i = j
    return out


def word_shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes per text, sorted within a text: (hashes, shingles per text).

    A text of fewer than ``k`` words, but not none, has its whole sequence as one shingle.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    coef = mix(np.arange(1, k + 1, dtype=U) * U(_BASE)) | U(1)
    m = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    total = int(m.sum())
    out = np.empty(total, dtype=U)
    if total:
        acc = np.zeros(len(h), dtype=U)
        for j in range(min(k, len(h))):
            acc[:len(h) - j] += h[j:] * coef[j]
        acc = mix(acc)
        for i in np.flatnonzero((counts > 0) & (counts < k)):  # short texts: own combination, tagged by length
            seq = h[begins[i]:ends[i]]
            acc[begins[i]] = mix(np.array([(seq * coef[:len(seq)]).sum(dtype=U) + U(len(seq))], dtype=U))[0]
    at = 0
    sizes = np.zeros(len(counts), dtype=np.int64)
    for i in np.flatnonzero(m):
        s = np.sort(acc[begins[i]:begins[i] + m[i]])
        if len(s) > 1:
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        out[at:at + len(s)] = s
        at += len(s)
        sizes[i] = len(s)
    return out[:at], sizes


def binary_column(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose i-th value is ``values`` up to element ``ends[i]`` (raw bytes)."""
    off = np.concatenate(([0], ends)).astype(np.int64) * values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends),
                                 [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def binary_values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``binary_column``: (all values, offsets in elements)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, off, data = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    size = np.dtype(dtype).itemsize
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=dtype), offsets * 0
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(raw.tobytes(), dtype=dtype), (offsets - offsets[0]) // size


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys`` (integers): tables holding whole groups only, with the groups' start rows.

    The last group of a batch is carried over to the next one.
    """
    kept: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows, dtype=bool)
        if kept:
            last = kept[-1]
            change[0] = any(last[k][last.num_rows - 1].as_py() != t[k][0].as_py() for k in keys)
        for k in keys:
            v = t[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        if len(cuts):
            done = pa.concat_tables([*kept, t.slice(0, cuts[-1])]) if kept else t.slice(0, cuts[-1])
            kept = [t.slice(cuts[-1])]
            if done.num_rows:
                yield done.combine_chunks(), _starts(done, keys)
        else:
            kept.append(t)
    if kept:
        done = pa.concat_tables(kept).combine_chunks()
        yield done, _starts(done, keys)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, dtype=bool)
    change[0] = True
    for k in keys:
        v = t[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)
