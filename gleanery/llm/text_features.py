"""Dense features of whole texts, from their bytes and words alone.

Shares of pairs of neighbouring byte classes tell shouting, symbols, digits, scripts and line shapes apart; the other
features count words, lines and n-grams that a text repeats. Shares enter by their square root, so that small ones count.
An empty text has zeros everywhere.
"""

import numpy as np

from gleanery.llm.hashing import BYTE_VALUES, POWERS, U64, buffers, gram_starts, grams, mix, row_chunks, word_hashes

LOWER, UPPER, DIGIT, SPACE, BREAK, MARK, SYMBOL, BEYOND = range(8)
CLASSES = 8


def _byte_classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.int64)
    table[128:] = BEYOND
    table[:33] = SPACE
    table[[10, 13]] = BREAK
    for kind, characters in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, b"0123456789"), (MARK, b".,;:?'\"()-")):
        table[list(characters)] = kind
    return table


BYTE_CLASSES = _byte_classes()
SHARES = ["follows_itself", "again_1", "again_2", "again_3", "again_lines", "short_lines"]
NAMES = [f"bytes_{a}{b}" for a in range(CLASSES) for b in range(CLASSES)] + SHARES + ["log_words", "log_word_bytes"]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.sqrt(part / np.maximum(whole, 1))


def _again(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row, how many hashes it holds beyond the distinct ones."""
    keys = hashes ^ mix(rows.astype(U64) + U64(1))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(rows[order[1:]][same], minlength=n_rows)


def _rows_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of bytes of each line with a byte in it."""
    cut = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), np.append(cut, len(data))[np.searchsorted(cut, starts)])
    full = ends > starts
    starts, ends = starts[full], ends[full]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    up, down = POWERS.upto(len(data) + 1)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_VALUES[data] * up[:-1], dtype=U64)])
    return rows, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)), ends - starts


def features(column) -> np.ndarray:
    """One row of `NAMES` for each text of an Arrow column; null counts as empty."""
    data, offsets = buffers(column)
    made = [_chunk(column.slice(a, b - a)) for a, b in row_chunks(offsets)]
    return np.concatenate(made) if made else np.zeros((0, len(NAMES)), np.float32)


def _chunk(column) -> np.ndarray:
    data, offsets = buffers(column)
    n = len(offsets) - 1
    rows = _rows_of(offsets)
    kinds = BYTE_CLASSES[data]
    inside = rows[1:] == rows[:-1]
    pairs = (rows[1:] * CLASSES + kinds[:-1])[inside] * CLASSES + kinds[1:][inside]
    pairs = np.bincount(pairs, minlength=n * CLASSES * CLASSES).reshape(n, -1)
    hashes, at = word_hashes(column)
    of_words, n_words = _rows_of(at), np.diff(at)
    follows = np.bincount(of_words[1:][(hashes[1:] == hashes[:-1]) & (of_words[1:] == of_words[:-1])], minlength=n)
    shares = [_share(follows, n_words - 1)]
    for size in (1, 2, 3):
        starts, ends = gram_starts(at, size)
        again = _again(grams(hashes, size)[starts], _rows_of(ends), n)
        shares.append(_share(again, np.diff(ends)))
    of_lines, line_hashes, widths = _lines(data, offsets)
    n_lines = np.bincount(of_lines, minlength=n)
    shares.append(_share(_again(line_hashes, of_lines, n), n_lines))
    shares.append(_share(np.bincount(of_lines[widths < 30], minlength=n), n_lines))
    sizes = np.diff(offsets)
    logs = [np.log1p(n_words) / 8, np.log1p(sizes / np.maximum(n_words, 1)) / 3]
    table = np.column_stack([_share(pairs, np.maximum(sizes - 1, 1)[:, None]), *shares, *logs])
    return table.astype(np.float32)
