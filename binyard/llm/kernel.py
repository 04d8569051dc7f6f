"""Vectorised text kernels for Arrow batches (numpy, no per-word Python).

A batch of texts is one UTF-8 buffer with row offsets.  Words are runs of
bytes other than space and \\t..\\r (all of them ASCII, so byte runs and
character runs agree).  A word's 64-bit hash is the sum of a random number
per byte times a power of an odd base, taken from prefix sums over the
buffer, then mixed.  Work is done in pieces of about a megabyte, so memory
does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

IS_SEP = np.zeros(256, dtype=bool)
IS_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    size = max(PIECE * 2, 1 << max(n - 1, 1).bit_length())
    if size not in _POWERS:
        tables = []
        for b in (_BASE, _BASE_INV):
            x = np.full(size, b, dtype=_U)
            x[0] = 1
            tables.append(np.multiply.accumulate(x))
        if size > PIECE * 2:
            return tables[0], tables[1]
        _POWERS[size] = (tables[0], tables[1])
    return _POWERS[size]


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.cast(pa.large_string()).fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(start, end, row, hash) of every word of a piece, in order."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, _U)
    sep = IS_SEP[data]
    non = ~sep
    first = non.copy()
    first[1:] &= sep[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = non[at]
    last = non.copy()
    last[:-1] &= sep[1:]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = non[at]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, s, side="right") - 1
    power, inverse = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=_U)
    total[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * power[: len(data)], out=total[1:])
    h = (total[e] - total[s]) * inverse[s]
    return s, e, row, mix(h + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingles(h: np.ndarray, row: np.ndarray, n_rows: int, k: int, whole_short: bool = True):
    """(hash, row, position) of the k-word shingles of every row, in order.

    A row of 1..k-1 words gives its whole sequence as one shingle; a row
    without words gives none."""
    weight = mix(np.arange(1, k + 1, dtype=_U))
    weight |= _U(1)
    n = len(h) - k + 1
    if n > 0:
        acc = h[:n] * weight[0]
        for j in range(1, k):
            acc += h[j : j + n] * weight[j]
        ok = np.flatnonzero(row[:n] == row[k - 1 :])
        out, at, pos = mix(acc[ok]), row[ok], ok
    else:
        out, at, pos = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if whole_short:
        counts = np.bincount(row, minlength=n_rows)
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            begin = np.concatenate(([0], np.cumsum(counts)))
            extra = np.array([int((h[begin[r] : begin[r + 1]] * weight[: counts[r]]).sum(dtype=_U)) for r in short], dtype=_U)
            extra = mix(extra + counts[short].astype(_U) * _U(0xA24BAED4963EE407))
            out = np.concatenate((out, extra))
            at = np.concatenate((at, short))
            pos = np.concatenate((pos, begin[short]))
            order = np.argsort(at, kind="stable")
            out, at, pos = out[order], at[order], pos[order]
    return out, at, pos


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a batch."""
    for a, b in pieces(offsets):
        part = data[offsets[a] : offsets[b]]
        off = offsets[a : b + 1] - offsets[a]
        _, _, row, h = words(part, off)
        sh, at, _ = shingles(h, row, b - a, k)
        cut = np.searchsorted(at, np.arange(b - a + 1))
        for r in range(b - a):
            x = np.sort(sh[cut[r] : cut[r + 1]])
            if len(x) > 1:
                keep = np.empty(len(x), dtype=bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                x = x[keep]
            yield a + r, x
