"""Vectorised words, hashes and n-grams over whole Arrow columns of UTF-8 text.

A word is a run of bytes outside 0x20 and 0x09-0x0D. No UTF-8 sequence of a longer character holds one of these
bytes, so splitting bytes splits characters rightly. All hashes are 64-bit and depend on the text alone.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK_BYTES = 1 << 20

IS_WORD = np.ones(256, np.uint8)
IS_WORD[list(SEPARATORS)] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits; one-to-one on 64 bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64))
LOWER_BYTE_VALUES = BYTE_VALUES.copy()
LOWER_BYTE_VALUES[65:91] = BYTE_VALUES[97:123]

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
GRAM_BASE = U64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up, self.down = self._row(BASE, size), self._row(BASE_INVERSE, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, size: int) -> np.ndarray:
        row = np.full(size, base, U64)
        row[0] = 1
        return np.multiply.accumulate(row)


POWERS = _Powers()


def text_column(column) -> pa.Array:
    """A string column as one large_string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return column.fill_null("").cast(pa.large_string())


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, and the offsets of its rows in them."""
    column = text_column(column)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the word offsets of the rows."""
    inside = IS_WORD[data]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    starts = inside.copy()
    starts[1:] &= 1 - inside[:-1]
    starts[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= 1 - inside[1:]
    edges = edges[edges > 0] - 1
    ends[edges] = inside[edges]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(column, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column in order, and the word offsets of its rows."""
    data, offsets = buffers(column)
    values = LOWER_BYTE_VALUES if lower else BYTE_VALUES
    hashes, ends = [], [np.zeros(1, np.int64)]
    done = 0
    for first, last in row_chunks(offsets):
        part = data[offsets[first] : offsets[last]]
        start, end, at = word_bounds(part, offsets[first : last + 1] - offsets[first])
        up, down = POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * up[:-1], out=sums[1:])
        hashes.append(mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64)))
        ends.append(at[1:] + done)
        done += len(start)
    return np.concatenate(hashes) if hashes else np.zeros(0, U64), np.concatenate(ends)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each position on; the last positions, which lack words, are left out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total, width, power, block, built = None, 1, GRAM_BASE, hashes, 0
    with np.errstate(over="ignore"):
        rest = size
        while True:
            if rest & 1:
                part = block[built : built + n]
                total = part.copy() if total is None else total * power + part
                built += width
            rest >>= 1
            if not rest:
                return mix(total)
            block = block[:-width] * power + block[width:]
            power, width = power * power, width * 2


def gram_starts(word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions, in the words of all rows, of the n-grams that stay in one row; and their offsets by row."""
    counts = np.maximum(np.diff(word_offsets) - size + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    shift = np.repeat(word_offsets[:-1] - offsets[:-1], counts)
    return np.arange(offsets[-1]) + shift, offsets
