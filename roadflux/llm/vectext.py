"""Vectorised text primitives on Arrow string buffers (numpy, no per-word Python)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.full(4096, 0xD6E8FEB86659FD93, _U))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.string())
    column = column.fill_null("")
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    if off is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(column: pa.Array, limit: int = SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of row ranges of about ``limit`` bytes."""
    data, off = buffer_of(column)
    lo, rows = 0, len(off) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, rows)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def _segment(data: np.ndarray, heads: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, starts and ends of one run of bytes; heads: where texts begin."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = heads[(heads > 0) & (heads < len(data))]
    first[heads] = inside[heads]
    last[heads - 1] = inside[heads - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, _U), starts, ends
    at = np.flatnonzero(inside)
    place = at - np.repeat(starts, ends - starts)
    value = (LOWER[data[at]] if fold else data[at]).astype(_U) + _U(1)
    value *= _POWERS[place & 4095]
    if len(place) and place.max() > 4095:  # every further 4,096 bytes of a word have weights of their own
        value *= np.where(place > 4095, mix((place >> 12).astype(_U)) | _U(1), _U(1))
    at = np.cumsum(ends - starts)
    total = np.add.reduceat(value, np.concatenate(([0], at[:-1])))
    return mix(total + (ends - starts).astype(_U) * _ODD), starts, ends


def words(data: np.ndarray, off: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased if ``fold``) of texts in one buffer.

    Returns hash, start, end per word, and per text the offsets into these.
    Buffers beyond SEGMENT are cut at white space, so memory follows the segment.
    """
    parts, lo, n = [], 0, len(data)
    while lo < n:
        hi = min(lo + SEGMENT, n)
        while hi < n and not SPACE[data[hi]]:
            step = SPACE[data[hi : hi + 4096]]
            hi += int(step.argmax()) if step.any() else len(step)
        a, b = np.searchsorted(off, [lo, hi])
        h, s, e = _segment(data[lo:hi], off[a:b] - lo, fold)
        parts.append((h, s + lo, e + lo))
        lo = hi
    if not parts:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, s, e, np.searchsorted(s, off)


def shingle_sets(hashes: np.ndarray, per_text: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its k-word shingles.

    Texts of one to k-1 words have one shingle, their whole sequence; texts
    without words have none.
    """
    n = len(hashes)
    scales = mix(np.arange(1, k + 1, dtype=_U) * _ODD) | _U(1)
    if n >= k:
        total = np.zeros(n - k + 1, _U)
        for i in range(k):
            total += hashes[i : n - k + 1 + i] * scales[i]
        total = mix(total)
    out = []
    for lo, hi in zip(per_text[:-1].tolist(), per_text[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(total[lo : hi - k + 1]))
        elif hi > lo:
            whole = (hashes[lo:hi] * scales[: hi - lo]).sum(dtype=_U, keepdims=True)
            out.append(mix(whole + np.array([hi - lo], _U) * _ODD))
        else:
            out.append(np.zeros(0, _U))
    return out
