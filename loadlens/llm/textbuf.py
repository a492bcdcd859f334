"""Columnar text kernels shared by the operators of this subpackage.

An Arrow string column is one byte buffer plus offsets.  The helpers here work
on that buffer as a whole (no Python loop over characters or words), so the
per-task code of the operators stays small.  A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes that separate words: space and 0x09 to 0x0D.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SEPARATOR = np.isin(np.arange(256), SEPARATORS)
#: A token is a run of ASCII letters and digits and of non-ASCII bytes, compared in lower case.
_BYTES = np.arange(256)
IS_BREAK = ~(((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Text handled at once inside a task; a longer document is handled alone.
PIECE_BYTES = 2 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the output."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def draws(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers of a seed."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U((seed * 0xD1342543DE82EF95) % 2**64))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, seed: int):
        self.base = (int(draws(1, seed)[0]) & ~7) | 5
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.base, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * U(pow(self.inverse, k, 2**64))])
        return self.up[:n], self.down[:n]


FAMILIES = (Powers(11), Powers(12))
BYTE_VALUES = (draws(256, 21), draws(256, 22))


class Windows:
    """Fingerprints of any slice of a sequence of 64-bit values.

    A slice's fingerprint depends on its values alone, not on where it lies:
    prefix sums of value * base**i are differenced and shifted back to i = 0.
    """

    def __init__(self, values: np.ndarray, family: int = 0):
        up, self.down = FAMILIES[family].to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its int64 offsets from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with the letters of ASCII and Latin-1 in lower case (0xC3 0x80 to 0x9E, but for the times sign)."""
    data = LOWER[data]
    second = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    data[second] += 0x20
    return data


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents [i, j) of about ``most`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, is_separator: np.ndarray = IS_SEPARATOR):
    """Start and end byte of every word, and each document's first word number.

    Words are maximal runs of non-separator bytes inside one document.
    """
    inside = ~is_separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit fingerprint for every word's bytes."""
    return Windows(BYTE_VALUES[family][data], family).names(start, end)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[k], starts[k]+1, ... counts[k] of them, for every k, concatenated."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(np.asarray(starts) - at, counts)


def per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over each document's slice (empty slices give 0)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def merged(low: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint runs that cover the same places as the slices [low, end); low ascends."""
    if not len(low):
        return low, end
    reach = np.maximum.accumulate(end)
    first = np.append(True, low[1:] > reach[:-1])
    return low[first], reach[np.append(first[1:], True)]


def unions(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """A mask over n positions: those inside a slice [s, s + width); the starts come in any order."""
    start = np.sort(start)
    heads, ends = merged(start, start + width)
    steps = np.zeros(n + 1, np.int8)
    steps[heads] = 1
    steps[np.minimum(ends, n)] -= 1
    return np.cumsum(steps[:n], dtype=np.int8).view(bool)
