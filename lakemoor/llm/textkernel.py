"""Vectorised word and shingle hashes over Arrow columns of bytes.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z become a-z. Hashes are functions
of the bytes alone, so they agree between workers, runs and machines. Memory is bounded by the
slice (``SLICE`` bytes, and the longest word) plus 8 bytes a word of the batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
#: Multipliers of the words of a shingle: odd numbers from a rule.
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def streams(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(BASE) + _U(seed)) | _U(1)


#: Byte -> lower-cased byte in words, 0 between words.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], dtype=np.uint8)
_BYTE = np.where(np.arange(256) > 0, streams(256, 7), 0).astype(np.uint64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, BASE, dtype=np.uint64)]))
    down = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)]))
    return up, down


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column (null: empty) and each row's start among them, with the end."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and each row's first word (with the end)."""
    hashes, starts, ends = [], [], []
    n, pos = len(buf), 0
    while pos < n:
        end = min(pos + SLICE, n)
        while end < n:  # on to the next byte between words, or the next row
            ahead = LOWER[buf[end : end + 4096]] == 0
            k = int(np.argmax(ahead))
            row = offs[np.searchsorted(offs, end)]
            if ahead[k]:
                end = min(end + k, int(row)) if row >= end else end + k
                break
            if end <= row < end + 4096:
                end = int(row)
                break
            end = min(end + 4096, n)
        low = LOWER[buf[pos:end]]
        inside = low > 0
        rows = offs[np.searchsorted(offs, pos) : np.searchsorted(offs, end)] - pos
        before = np.zeros(len(low), dtype=bool)
        before[1:] = inside[:-1]
        before[rows] = False
        after = np.zeros(len(low), dtype=bool)
        after[:-1] = inside[1:]
        after[rows[rows > 0] - 1] = False
        s, e = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        size = SLICE * 2
        while size < len(low):
            size *= 2
        up, down = _powers(size)
        total = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[low] * up[: len(low)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + pos)
        ends.append(e + pos)
        pos = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), starts, np.concatenate(ends), np.searchsorted(starts, offs)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words, and the row of each; a row of 1 to k-1 words has one shingle of all of them."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    by = streams(k, 11)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    room = np.minimum(first[rows + 1] - np.arange(n), k)  # words from here to the row's end, k at most
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        reach = room[: n - j] > j if j else slice(None)
        total[: n - j][reach] += (hashes[j:] * by[j])[reach]
    short = np.diff(first)[rows] < k
    take = (room == k) | (short & (np.arange(n) == first[rows]))
    return mix(total[take] + room[take].astype(np.uint64)), rows[take]


def counted(elements: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each row, ordered, with their rows and counts."""
    if not len(elements):
        return elements, rows, np.zeros(0, np.int64)
    order = np.lexsort((elements, rows))
    e, r = elements[order], rows[order]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return e[at], r[at], np.diff(np.append(at, len(e)))
