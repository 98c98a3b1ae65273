"""Frequent n-grams with the counts of all their parts, counted by the numbers of their words.

A gram is a first word with n - 1 later ones in the window. Its parts are the sets of its places that hold the first one: those
that share the first two places of a family (1 and k) are all read off the family's rows of numbers, (w1, wk, ..., wn), with 0
where the text has ended or the word is too rare for a frequent gram. So a family is shuffled once, as compressed numbers in
buckets by (w1, wk), and each bucket gives whole counts of the family's sets. A set without the first place is counted as
the set that begins at it. Only entries found often enough leave a bucket: a part is at least as frequent as its gram. A word
may be rarer than its gram, as each of its places is in one gram for every choice of the others.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.word_blocks import blocks, encoded, numbered, packed, unpacked, word_counts

#: Rows of numbers in a bucket, about, before equal ones meet.
ROWS = 2_000_000
LIMIT = 1 << 62


def _families(n: int, window: int) -> list[tuple[tuple[int, ...], Counter]]:
    """For each second place: the places of the rows, and the offsets that they take, with the number of ways to."""
    shapes = [(0, *later) for later in combinations(range(1, window), n - 1)]
    rows = [(1, *range(k, n + 1)) for k in range(2, n + 1)]
    return [(places, Counter(tuple(shape[p - 1] for p in places) for shape in shapes)) for places in rows]


def _row_keys(columns: list[np.ndarray]) -> np.ndarray:
    """A whole number for each row, equal and ordered as the rows are."""
    keys, bound = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        size = int(column.max(initial=0)) + 1
        if bound * size > LIMIT:
            values, keys = np.unique(keys, return_inverse=True)
            bound = len(values)
        keys = keys * size + column
        bound *= size
    return keys


def _summed(columns: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order, and the sums of their times."""
    if not len(times):
        return columns, times
    keys = _row_keys(columns)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [c[order[starts]] for c in columns], np.add.reduceat(times[order], starts)


def _rows_of(numbers: np.ndarray, left: np.ndarray, shapes: Counter) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of a family in a block, and how often it has each; `left`: words of the text from a place on."""
    columns, times = [], []
    for offsets, ways in shapes.items():
        firsts = np.flatnonzero((left > offsets[1]) & (numbers > 0))
        firsts = firsts[numbers[firsts + offsets[1]] > 0]
        there = [np.where(left[firsts] > o, numbers[np.minimum(firsts + o, len(numbers) - 1)], 0) for o in offsets]
        columns.append(there)
        times.append(np.full(len(firsts), ways, np.int32))
    return _summed([np.concatenate(c) for c in zip(*columns)], np.concatenate(times))


def _buckets_of(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def _name(places: tuple[int, ...], n: int) -> str:
    return "n_" + "".join("i" if j + 1 in places else "x" for j in range(n))


def _sets(places: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The family's sets of places, the whole one first."""
    return [(*places[:2], *later) for size in range(len(places) - 2, -1, -1) for later in combinations(places[2:], size)]


def _code(places: tuple[int, ...]) -> int:
    return sum(1 << (p - 1) for p in places)


def _counted(codes: DataFrame, n: int, families: list, n_buckets: int, least: int) -> DataFrame:
    """places (as a code), k1 ... kn (the numbers at these places), n, and for whole grams the counts of their own family."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, numbers in zip(*(batch.column(i).to_pylist() for i in range(2))):
                lengths, numbers = unpacked(lengths), unpacked(numbers)
                left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(numbers))
                for family, (_, shapes) in enumerate(families):
                    columns, times = _rows_of(numbers, left, shapes)
                    bucket = _buckets_of(columns[0], columns[1], n_buckets)
                    order = np.argsort(bucket, kind="stable")
                    ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                    made = [(b, order[ends[b] : ends[b + 1]]) for b in np.flatnonzero(np.diff(ends))]
                    rows = [packed(np.concatenate([np.diff(columns[0][at], prepend=0), *[c[at] for c in columns[1:]], times[at]]).astype(np.int32)) for _, at in made]
                    kinds = [pa.array([family] * len(made), pa.int32()), pa.array([int(b) for b, _ in made], pa.int32()), pa.array(rows, pa.binary())]
                    yield pa.RecordBatch.from_arrays(kinds, names=["family", "bucket", "rows"])

    owns = [_name(places, n) for places in _sets(families[0][0])[1:]]
    fields = ["places int", *[f"k{j + 1} int" for j in range(n)], "n long", *[f"{name} long" for name in owns]]

    def added(group: pa.Table) -> pa.Table:
        family = group.column("family")[0].as_py()
        places = families[family][0]
        parts = [unpacked(rows).reshape(len(places) + 1, -1) for rows in group.column("rows").to_pylist()]
        firsts = np.concatenate([np.cumsum(p[0]) for p in parts])
        others = np.concatenate([p[1:] for p in parts], axis=1)
        columns, times = _summed([firsts, *others[:-1]], others[-1].astype(np.int64))
        at = {p: c for p, c in zip(places, columns)}
        made, own, whole = [], [], None
        for some in _sets(places):
            here = np.flatnonzero(np.all([at[p] > 0 for p in some], axis=0))
            keys, first, row = np.unique(_row_keys([at[p][here] for p in some]), return_index=True, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, row, times[here])
            often = np.flatnonzero(sums >= least)
            spots = here[first[often]]
            made.append([np.full(len(often), _code(some)), *[at[p][spots] for p in some], *[np.zeros(len(often), int)] * (n - len(some)), sums[often]])
            if some == families[0][0]:
                whole = spots
            elif family == 0:
                own.append(sums[row[np.searchsorted(here, whole)]])
        found = [np.concatenate(c) for c in zip(*made)]
        for i in range(len(owns)):
            found.append(np.concatenate([own[i], np.zeros(len(found[0]) - len(whole), np.int64)]) if family == 0 else np.zeros(len(found[0]), np.int64))
        return pa.table({f.split()[0]: pa.array(c.astype("int64" if f.endswith("long") else "int32")) for f, c in zip(fields, found)})

    return codes.mapInArrow(cut, "family int, bucket int, rows binary").groupBy("family", "bucket").applyInArrow(added, ", ".join(fields))


def frequent_grams(texts: DataFrame, tokens: Column, n: int, window: int, least: int) -> DataFrame:
    """w1 ... wn, the count of the gram and of all its parts, each named by the places it fixes (i) and leaves open (x)."""
    packs = blocks(texts, tokens)
    families, ways = _families(n, window), comb(window - 1, n - 1)
    words = numbered(word_counts(packs), -(-least // ways))
    n_words = packs.agg(F.sum("size")).first()[0] or 0
    codes = encoded(packs, words).checkpoint()
    found = _counted(codes, n, families, n_words * ways // ROWS + 1, least).checkpoint()

    every = families[0][0]
    owns = [_name(places, n) for places in _sets(every)[1:]]
    keys = [F.col(f"k{j}").alias(f"w{j}") for j in every]
    grams = found.where(F.col("places") == _code(every)).select(*keys, F.col("n").alias(_name(every, n)), *owns)
    for some in [places for size in range(n - 1, 1, -1) for places in combinations(every, size) if places[:2] != (1, 2)]:
        moved = tuple(p - some[0] + 1 for p in some)
        side = found.where(F.col("places") == _code(moved))
        side = side.select(*[F.col(f"k{j + 1}").alias(f"w{p}") for j, p in enumerate(some)], F.col("n").alias(_name(some, n)))
        grams = grams.join(side, [f"w{p}" for p in some], "left").fillna(0, [_name(some, n)])
    for p in every:
        side = words.select(F.col("number").alias(f"w{p}"), F.col("word").alias(f"_w{p}"), (F.col("n") * ways).alias(_name((p,), n)))
        grams = grams.join(side, f"w{p}").drop(f"w{p}").withColumnRenamed(f"_w{p}", f"w{p}")
    return grams.withColumn(_name((), n), F.lit(n_words * ways).cast("long"))
