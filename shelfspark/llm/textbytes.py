"""Vectorised work on the UTF-8 bytes of Arrow text columns: chunks, words, word hashes and distinct sets.

All functions see whole texts. Words are runs of bytes of a class, which is exact for classes that hold every or no
byte above 0x7F. Hashes have 64 bits and do not depend on process or platform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 2 << 20
LONG_WORD = 512

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but ASCII blanks (0x20, 0x09-0x0D).
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII digits, ASCII letters a-z and every byte above 0x7F.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_MASK = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the public splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_chunks(column: pa.Array, lower: bool = True, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes followed by 8 zeros, row offsets into them); nulls are empty; rows are never cut."""
    n = len(column)
    if n == 0:
        return
    wide = column.cast(pa.large_string()).fill_null("")
    _, offs, data = wide.buffers()
    off = np.frombuffer(offs, np.int64)[wide.offset : wide.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        a, b = int(off[lo]), int(off[hi])
        buf = np.zeros(b - a + 8, np.uint8)
        if lower:
            np.take(LOWER, raw[a:b], out=buf[: b - a])
        else:
            buf[: b - a] = raw[a:b]
        yield lo, hi, buf, (off[lo : hi + 1] - a)
        lo = hi


def words(buf: np.ndarray, row_off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each word, and for each row the index of its first word (one more entry at the end)."""
    n = len(buf) - 8
    inside = table[buf[:n]]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = row_off[(row_off > 0) & (row_off < n)]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e - s, np.searchsorted(s, row_off)


def hash_words(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    view = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    h = mix(lens.astype(U) * U(0x9E3779B97F4A7C15))
    sel, at = np.arange(len(starts)), 0
    if len(lens) and (big := np.flatnonzero(lens > LONG_WORD)).size:
        for i in big:
            word = buf[starts[i] : starts[i] + lens[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        sel = np.flatnonzero(lens <= LONG_WORD)
    while sel.size:
        left = lens[sel] - at
        block = view[starts[sel] + at] & _MASK[np.minimum(left, 8)]
        h[sel] = mix(h[sel] ^ block)
        at += 8
        sel = sel[left > 8]
    return h


def kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (positions up to len - k)."""
    n = max(0, len(h) - k + 1)
    g = mix(h[:n] + U(k))
    for j in range(1, k):
        g = mix(g * U(0x9E3779B97F4A7C15) + h[j : n + j])
    return g


def shingle_sets(buf: np.ndarray, row_off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each row as sorted hashes, and the row offsets into them.

    Words are runs of non-blank bytes. A row with fewer words has all of them as its only shingle; one without words has none.
    """
    s, ln, first = words(buf, row_off, NOT_BLANK)
    h = hash_words(buf, s, ln)
    per_row = np.diff(first)
    if len(h) == 0:
        return np.zeros(0, U), np.zeros(len(row_off), np.int64)
    size = np.minimum(per_row, k)
    many = per_row - size + (per_row > 0)
    off = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(off[-1]) + np.repeat(first[:-1] - off[:-1], many)
    size = np.repeat(size, many)
    grams = mix(h[at] + size.astype(U) * U(0x632BE59BD9B4E019))
    for j in range(1, k):
        more = np.flatnonzero(size > j)
        grams[more] = mix(grams[more] * U(0x9E3779B97F4A7C15) + h[at[more] + j])
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[off[:-1][np.diff(off) > 0]] = True
    return grams[new], np.concatenate([[0], np.cumsum(new)])[off]


def binary_column(rows: np.ndarray) -> pa.Array:
    """A binary column from a matrix of bytes, one value for each of its rows."""
    n, w = rows.shape
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * w)), pa.py_buffer(np.ascontiguousarray(rows, np.uint8))])


def ragged_binary(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column from an array of any type, cut at element offsets."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    """The rows of a binary column whose values all have the same width in bytes."""
    if len(column) == 0:
        return np.zeros((0, width // np.dtype(dtype).itemsize), dtype)
    col = column.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset]
    raw = np.frombuffer(col.buffers()[2], np.uint8)[off : off + len(col) * width]
    return raw.reshape(len(col), width).view(dtype)
