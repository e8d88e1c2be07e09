"""Vectorised hashes over whole Arrow batches of texts: words, n-grams and window minimizers.

All functions take flat numpy arrays plus document offsets, so that a batch of any documents costs a
fixed number of numpy calls. Hashes are 64-bit polynomials in wrapping arithmetic over random byte
values, followed by a mixer; equal content gives equal values on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240115)).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

#: The six ASCII characters that separate words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Bytes that are worked on at once, so that arrays stay in a core's cache; a longer document is one piece of its own.
PIECE_BYTES = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of wrapping products over all bits."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        seed = np.full(size, base, dtype=np.uint64)
        seed[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(seed)
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * P**i``; the hash of a range is a difference (see ``ranges``)."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_P, len(values)), out=out[1:])
    return out


def ranges(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``[start, end)``, whatever their place."""
    return mix((pre[end] - pre[start]) * _powers(_PINV, len(pre))[start])


def grams(pre: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` values (one for each start that has room)."""
    room = max(0, len(pre) - n)
    return mix((pre[n : n + room] - pre[:room]) * _powers(_PINV, room))


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        a = np.minimum(a[:-step], a[step:]) if len(a) > step else a[:0]
        have += step
    return a


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a binary Arrow column without copying it; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes (one document at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each document the index of its first word (n + 1 values)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = SPACE[data]
    edge = np.ones(n + 1, dtype=bool)  # a word can't go on over these places
    edge[1:n] = gap[:-1]
    first = edge[:n] & ~gap
    starts_at = offsets[:-1][offsets[:-1] < n]
    first[starts_at] = ~gap[starts_at]
    start = np.flatnonzero(first)
    last = np.ones(n, dtype=bool)
    last[:-1] = gap[1:]
    last &= ~gap
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    last[ends_at] = ~gap[ends_at]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return ranges(prefix(byte_values(data)), start, end)


def runs(keys: np.ndarray, first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of equal keys that don't cross a True in ``first``, cut after ``longest`` values.

    Returns start and end (exclusive) of each run.
    """
    n = len(keys)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(n, dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new |= first
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    if size.max() > longest:
        parts = -(-size // longest)
        base = np.repeat(at, parts)
        within = np.arange(len(base)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = base + within * longest
    return at, np.append(at[1:], n)


def windows(values: np.ndarray, bounds: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window of ``size`` values inside its document, and its minimizer.

    ``bounds`` has each document's first value (n + 1 entries). The minimizer is the least hash of the
    ``gram``-long runs in the window, so equal windows have equal minimizers and neighbours mostly share one.
    Returns the windows' starts and the minimizers.
    """
    pre = prefix(values)
    least = sliding_min(grams(pre, gram), size - gram + 1)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.zeros(len(values) + 1, dtype=np.int32)  # +1 where a document's windows begin, -1 where they end
    length = np.diff(bounds)
    fits = length >= size
    np.add.at(ok, bounds[:-1][fits], 1)
    np.add.at(ok, bounds[1:][fits] - size + 1, -1)
    start = np.flatnonzero(np.cumsum(ok)[: len(least)] > 0)
    return start, least[start]
