"""Periodic runs of words, from Lyndon arrays that the grouping phase of Baier's suffix sorter yields.

A run is a stretch of words with smallest period q that neither neighbour extends; reported are those of at least
`EXPONENT` periods and `MIN_LENGTH` words. Every run holds a Lyndon root: a Lyndon word of length q that is the longest
one starting at its place, under the order of the words or under the reverse order (Bannai et al., The runs theorem,
2017). So the Lyndon arrays under both orders name all periods, and the longest common extensions of a root and its
copy, to the left and to the right, give the run.

Baier's phase one (Linear-time suffix sorting, 2016) groups the places of a text by the longest Lyndon word that starts
there. It is used for just that: its groups' context lengths are the Lyndon array, under either order, in linear time.

A word of a run of four periods occurs four times in it. Texts are therefore first cut at words that are rarer than
that in their text, then in their stretch, and so on; what is cut away lies in no run, so the runs stay the same.

No shuffle: each text is read in its own row. A null or empty text has no words and no runs. A null seed leaves a text as
it is. Rows with equal ids are separate texts. Memory grows with the longest text, by some ten times its size.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.hashing import buffers, row_chunks, text_column

MIN_LENGTH = 6
EXPONENT = 4

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_array(codes: list[int], flip: bool = False) -> list[int]:
    """Length of the longest Lyndon word from each place on, with the codes in ascending or (`flip`) descending order.

    Groups are taken from the highest on. The members of the group taken leave a list of open places; the place in front
    of a member is then its parent, whose longest Lyndon word goes on over all members that follow it as
    its children. Parents of one group with equally many children become a group of their own, just above their old one.
    """
    n = len(codes)
    by_code: dict[int, list[int]] = {}
    for place, code in enumerate(codes, 1):
        by_code.setdefault(code, []).append(place)
    members = [by_code[code] for code in sorted(by_code, reverse=flip)]
    group, found = [0] * (n + 1), [0] * (n + 1)
    for g, places in enumerate(members):
        for place in places:
            group[place] = g
    context = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    before, behind = list(range(-1, n + 1)), list(range(1, n + 3))
    taken = len(members) - 1
    while taken >= 0:
        length = context[taken]
        parents, children, last = [], [], 0
        for place in members[taken]:
            if group[place] != taken:
                continue
            found[place] = length
            parent, after = before[place], behind[place]
            behind[parent], before[after] = after, parent
            if parent != last:
                parents.append(parent)
                children.append(1)
                last = parent
            elif parent:
                children[-1] += 1
        members[taken] = ()
        splits: dict[tuple[int, int], list[int]] = {}
        for parent, n_children in zip(parents, children):
            splits.setdefault((n_children, group[parent]), []).append(parent)
        for n_children, old in sorted(splits, reverse=True) if len(splits) > 1 else splits:
            new, places = len(members), splits[n_children, old]
            members.append(places)
            context.append(context[old] + n_children * length)
            higher = above[old]
            below.append(old)
            above.append(higher)
            below[higher] = above[old] = new
            for place in places:
                group[place] = new
        taken = below[taken]
    return found[1:]


def common_right(x: np.ndarray, i: int, j: int) -> int:
    """How many codes from `i` and from `j` > i on are equal."""
    done, step, most = 0, 64, len(x) - j
    while done < most:
        step = min(step, most - done)
        other = x[i + done : i + done + step] != x[j + done : j + done + step]
        if other.any():
            return done + int(other.argmax())
        done, step = done + step, step * 2
    return most


def common_left(x: np.ndarray, i: int, j: int) -> int:
    """How many codes in front of `i` and of `j` > i are equal."""
    return common_right(x[:j][::-1], 0, j - i) if i else 0


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> set[tuple[int, int, int]]:
    """All runs (start, length, period) of at least `min_length` codes and `exponent` (2 or more) periods."""
    found = set()
    listed = codes.tolist()
    n = len(listed)
    for flip in (False, True):
        roots = np.array(lyndon_array(listed, flip), np.int64)
        # A run of e periods holds e - 1 equal roots in a row.
        at = np.arange(n)
        for k in range(1, exponent - 1):
            at = at[at + (k + 1) * roots[at] <= n]
            at = at[roots[at + k * roots[at]] == roots[at]]
        period = roots[at]
        order = np.lexsort((at, period))
        ends: dict[int, int] = {}
        for i, p in zip(at[order].tolist(), period[order].tolist()):
            if i + 2 * p <= ends.get(p, 0):
                continue  # within the run found last
            right = common_right(codes, i, i + p)
            start, end = i - common_left(codes, i, i + p), i + p + right
            ends[p] = end
            if end - start >= max(min_length, exponent * p):
                found.add((start, end - start, p))
    return found


def stretches(codes: np.ndarray, least: int = EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """Places [start, end) between codes that are 0 or rarer than `least` in their stretch.

    Cutting goes on as long as it removes an eighth of what is left.
    """
    alive = codes > 0
    width = int(codes.max(initial=0)) + 1
    while True:
        at = np.flatnonzero(alive)
        if not len(at):
            return []
        first = np.ones(len(at), bool)
        first[1:] = np.diff(at) > 1
        stretch = np.cumsum(first) - 1
        _, kind, counts = np.unique(stretch * width + codes[at], return_inverse=True, return_counts=True)
        gone = (counts[kind] < least) | (np.bincount(stretch) < min_length)[stretch]
        if 8 * np.count_nonzero(gone) < len(at):
            starts = at[first]
            return list(zip(starts.tolist(), (starts + np.bincount(stretch)).tolist()))
        alive[at[gone]] = False


def looped(words: list[bytes], seed: int | None) -> list[bytes]:
    """The words with a periodic tail, if 10 divides the seed: from word g % n on, the first 1 + (rest / (3 + g % 8)) repeat."""
    n = len(words)
    if seed is None or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start and then by period."""
    coded, borders, place = [np.zeros(1, np.int64)], [], 1
    for words in texts:
        often = (w for w, n in Counter(words).items() if n >= EXPONENT)
        codes = {w: i for i, w in enumerate(often, 1)}
        borders.append(place)
        if codes:
            coded.append(np.fromiter(map(codes.get, words, repeat(0)), np.int64, len(words)))
            coded.append(np.zeros(1, np.int64))
            place += len(words) + 1
    flat = np.concatenate(coded)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    cuts = stretches(flat)
    rows = np.searchsorted(borders, [a for a, _ in cuts], side="right") - 1
    for (a, b), row in zip(cuts, rows.tolist()):
        shift = a - borders[row]
        found[row] += [(start + shift, length, p) for start, length, p in runs_of(flat[a:b])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; of equal ones the first, then that of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when each run keeps its first period only, joined by single spaces."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [w for w, k in zip(words, keep.tolist()) if k]
    return b" ".join(words)


def _structs(runs: list[tuple[int, int, int]], mask: np.ndarray | None = None) -> pa.Array:
    table = np.array(runs, np.int64).reshape(-1, 3)
    columns = [pa.array(table[:, i]) for i in range(3)]
    return pa.StructArray.from_arrays(columns, fields=list(RUN), mask=None if mask is None else pa.array(mask))


def with_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: Column | None = None) -> DataFrame:
    """Per row: key, n_words, runs (by start, then period), strongest (a run or null), collapsed (the text without repeats).

    `seed` gives texts a periodic tail first, see `looped`.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch.column("text"))
            for first, last in row_chunks(buffers(column)[1]):
                part = batch.slice(first, last - first)
                texts = column.slice(first, last - first).cast(pa.large_binary()).to_pylist()
                words = [looped(t.split(), s) for t, s in zip(texts, part.column("seed").to_pylist())]
                found = runs_of_texts(words)
                best = [strongest(runs) for runs in found]
                offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in found])])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _structs([r for runs in found for r in runs]))
                left = [collapsed(w, runs).decode() for w, runs in zip(words, found)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array([len(w) for w in words], pa.int64()),
                        lists,
                        _structs([b or (0, 0, 0) for b in best], np.array([b is None for b in best], bool)),
                        pa.array(left, pa.string()),
                    ],
                    ["key", "n_words", "runs", "strongest", "collapsed"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    struct = "struct<start:bigint,length:bigint,period:bigint>"
    schema = f"key {kind}, n_words long, runs array<{struct}>, strongest {struct}, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
