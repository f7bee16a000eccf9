"""Vectorised hashing of words in Arrow string columns (numpy only, no per-word Python objects)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: list[np.ndarray] = []
#: ASCII white space, the separators of a word.
SPACES = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def salt(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) | np.uint64(1)


_BYTE_KEYS = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of them."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
        for out, base in ((up, _BASE), (down, pow(_BASE, -1, 1 << 64))):
            out[0], filled, step = 1, 1, base
            while filled < size:
                take = min(filled, size - filled)
                out[filled : filled + take] = out[:take] * np.uint64(step)
                filled, step = filled + take, step * step & (1 << 64) - 1
        _POWERS[:] = [up, down]
    return _POWERS[0], _POWERS[1]


def lookup(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SPACE = lookup(SPACES)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) with at most `most` bytes, or one longer row."""
    raw, at = text_bytes(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start, end) of every word, a maximal run of bytes that are no ASCII white space in one row."""
    n = len(raw)
    if lower:
        raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < n]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[raw] * up[:n], out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashed, np.searchsorted(at, start, "right") - 1, start, end


def shingles(hashed: np.ndarray, row: np.ndarray, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the runs of `size` words; a row with fewer words, but some, has its whole sequence as the one run."""
    counts = np.bincount(row, minlength=n_rows)
    keys, n = salt(size, 11), len(hashed)
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    out, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total += hashed[k : n - size + 1 + k] * keys[k]
        whole = row[: n - size + 1] == row[size - 1 :]
        out, rows = mix(total[whole]), row[: n - size + 1][whole]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        total = counts[few].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(size - 1):
            has = counts[few] > k
            total[has] += hashed[firsts[few[has]] + k] * keys[k]
        out, rows = np.concatenate((out, mix(total))), np.concatenate((rows, few))
    return out, rows


def distinct(hashed: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (hash, row) once, ordered by row and hash."""
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    keep = np.ones(len(hashed), bool)
    keep[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    return hashed[keep], row[keep]
