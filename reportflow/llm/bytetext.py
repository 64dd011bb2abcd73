"""Numpy helpers over the UTF-8 bytes of an Arrow batch of texts.

An Arrow string column already is one byte buffer plus offsets, so the
operators that look at bytes, words or shingles work on whole buffers and never
build Python strings.  ``chunks`` cuts a batch into runs of documents of a few
megabytes, which bounds the temporaries (a document longer than that is a chunk
of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# U+0020 and U+0009 to U+000D; every one is a single byte in UTF-8.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_LETTER = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base to the powers 0..n-1, and its inverse (modulo 2**64)."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for k, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``len + 1`` offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or
                                  pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if len(off) == 0:
        off = np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(data: np.ndarray, off: np.ndarray,
           size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents: (first, last, bytes, offsets)."""
    first, n = 0, len(off) - 1
    while first < n:
        last = int(np.searchsorted(off, off[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[off[first]:off[last]], off[first:last + 1] - off[first]
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[data]


def collapse_spaces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with every white space run of a document made one space."""
    space = _SPACE[data]
    drop = np.zeros(len(data), bool)
    drop[1:] = space[1:] & space[:-1]
    first = off[:-1][off[:-1] < len(data)]
    drop[first] = False
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return np.where(space, np.uint8(32), data)[~drop], kept[off]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each document."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges; equal ranges hash alike anywhere."""
    up, down = powers(len(data) + 1)
    letters = _LETTER if not seed else mix(_LETTER + np.uint64(seed)) | np.uint64(1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * up[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def windows(first: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` consecutive hashes."""
    n = len(first) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = mix(h * np.uint64(_BASE) + first[j:j + n])
    return h


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes per document: (hashes, offsets), ascending in each.

    A document with fewer words than ``width`` has its whole sequence as one
    shingle; without words it has none.
    """
    data = lower(data)
    starts, ends, before = words(data, off)
    h = spans_hash(data, starts, ends)
    count = np.diff(before)
    doc = np.repeat(np.arange(len(count)), count)
    whole = windows(h, width)
    same = doc[:len(whole)] == doc[width - 1:] if len(whole) else np.zeros(0, bool)
    sh, sd = whole[same], doc[:len(whole)][same]
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        extra = np.array([_sequence(h[before[i]:before[i + 1]]) for i in few], np.uint64)
        sh, sd = np.concatenate([sh, extra]), np.concatenate([sd, few])
    order = np.lexsort((sh, sd))
    sh, sd = sh[order], sd[order]
    if len(sh):
        keep = np.ones(len(sh), bool)
        keep[1:] = (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])
        sh, sd = sh[keep], sd[keep]
    return sh, np.searchsorted(sd, np.arange(len(off)))


def _sequence(h: np.ndarray) -> int:
    """Hash of a short sequence of word hashes; its length is part of it."""
    x = np.array([len(h)], np.uint64)
    for w in h:
        x = mix(x * np.uint64(_BASE) + w)
    return int(x[0])


def planes(a: np.ndarray) -> bytes:
    """An integer array as bytes of equal weight side by side, which compress well."""
    rows = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)
    return np.ascontiguousarray(rows.T).tobytes()


def from_planes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    x = np.frombuffer(b, np.uint8).reshape(size, len(b) // size)
    return np.ascontiguousarray(x.T).reshape(-1).view(dtype)
