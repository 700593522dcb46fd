"""Vectorised text kernels over Arrow string columns (numpy, no Python strings).

A batch of texts is one UTF-8 buffer plus row bounds. Words, their 64-bit
hashes and their shingles come out as arrays over the whole batch; rows are
processed in slices of about ``CHUNK_BYTES`` so that memory stays bounded by
the slice (or by the longest single text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A slice's arrays take some two hundred times its bytes where n-grams are scored,
# in every Python worker beside a heap that may be full.
CHUNK_BYTES = 1 << 18

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: every input bit reaches every output bit."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, p in enumerate((_P, _P_INV)):
            steps = np.full(size, p, dtype=_U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n+1 row bounds; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, bounds


def slices(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes each, one row at least."""
    row, n = 0, len(bounds) - 1
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of every row, and
    the n+1 positions of the rows in that list. ``bounds`` starts at 0."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    end = bounds[1:][bounds[1:] > 0] - 1
    last[end] = inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one running sum over the buffer."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_VALUE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its ``width``-word shingles of the
    text with A-Z lower-cased; a shorter text is one shingle, an empty one none."""
    data = ASCII_LOWER[data]
    starts, ends, row = word_bounds(data, bounds)
    word = span_hashes(data, starts, ends)
    n = len(word)
    odd = mix(np.arange(1, width + 1, dtype=_U)) | _U(1)
    full = np.zeros(max(n - width + 1, 0), _U)
    for k in range(width):
        full += word[k : k + len(full)] * odd[k]
    full = mix(full)
    out = []
    for a, b in zip(row[:-1].tolist(), row[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            short = word[a:b] * odd[: b - a]
            out.append(mix(short.sum(keepdims=True) + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def code_points(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the buffer and the row bounds counted in code points."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=seen[1:])
    return points, seen[bounds]
