"""Vectorised text helpers for code that runs on Arrow batches inside tasks.

Texts stay UTF-8 byte buffers: words are located and hashed with array
operations over a whole slice of documents, never per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept and extended per process)."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 17)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), in a new array."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``limit`` bytes each (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, i: int, j: int, space: np.ndarray = SPACE):
    """Words ``[^\\x20\\x09-\\x0D]+`` of rows [i, j), A-Z lower-cased for the hash.

    ``space`` marks the bytes that separate words. Returns (starts, ends, row, hashes): byte positions within the slice that
    begins at ``offsets[i]``, the row of each word, and a 64-bit hash of it.
    """
    base = int(offsets[i])
    b = LOWER[data[base: int(offsets[j])]]
    if not len(b):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    word = ~space[b]
    first = np.zeros(len(b) + 1, bool)
    first[offsets[i:j] - base] = True  # a row starts here
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    hashes = mix((total[e] - total[s]) * down[s])
    row = np.searchsorted(offsets[i:j + 1] - base, s, "right") - 1 + i
    return s, e, row, hashes


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, first_row: int, k: int):
    """Hashes of every k consecutive words within a row; a row with 1..k-1 words is one shingle.

    Returns (shingle hashes, row of each), in text order.
    """
    n = np.bincount(row - first_row, minlength=rows)
    begin = np.concatenate(([0], np.cumsum(n)))
    if not len(hashes):
        return hashes, row
    m = len(hashes) - k + 1
    out_h, out_r = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if m > 0:
        h = hashes[:m].copy()
        for t in range(1, k):
            h = h * BASE + hashes[t: m + t]
        inside = row[:m] == row[k - 1:]
        out_h, out_r = h[inside], row[:m][inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        more = []
        for r in short:
            h = hashes[begin[r]]
            with np.errstate(over="ignore"):
                for x in hashes[begin[r] + 1: begin[r + 1]]:
                    h = h * BASE + x
                more.append(h * BASE + np.uint64(n[r]))
        out_h = np.concatenate((out_h, np.array(more, np.uint64)))
        out_r = np.concatenate((out_r, short + first_row))
        order = np.argsort(out_r, kind="stable")
        out_h, out_r = out_h[order], out_r[order]
    return mix(out_h), out_r
