"""N-grams that a hypothesis shares with its references, found a batch of pairs at a time: no n-gram is shuffled to be matched.

Hypotheses have (pair, tokens), references (pair, ref, tokens). The texts of a pair meet in one row, and those that repeat a
key are counted together.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pairs whose n-grams are sorted together; bounds what a task holds beside its batch.
ROWS = 128
# Stands between the words of a gram; no word holds it.
SEPARATOR = "\x1f"


def _side_by_side(hyps: DataFrame, refs: DataFrame) -> DataFrame:
    """pair, hyp, refs: all texts of a pair, which has both sides."""
    hyp = hyps.groupBy("pair").agg(F.collect_list("tokens").alias("hyp"))
    ref = refs.groupBy("pair").agg(F.collect_list(F.struct("ref", "tokens")).alias("refs"))
    return hyp.join(ref, "pair")


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(owner: np.ndarray, gram: np.ndarray, n_grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner's distinct grams, in order, and how often it has them."""
    key, count = np.unique(owner * n_grams + gram, return_counts=True)
    return key // n_grams, key % n_grams, count


class _Places:
    """All words of some pairs, one after the other: the hypotheses' first, then the references'."""

    def __init__(self, part: pa.RecordBatch) -> None:
        hyp, refs = part.column("hyp"), part.column("refs")
        self.ref, ref_tokens = refs.flatten().flatten()
        hyp_tokens = hyp.flatten()
        rows = np.arange(len(part))
        hyp_pair, ref_pair = np.repeat(rows, _lengths(hyp)), np.repeat(rows, _lengths(refs))
        names = self.ref.dictionary_encode(null_encoding="encode")
        name = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A pair's references of one name are one reference.
        _, self.first_ref, ref_owner = np.unique(ref_pair * max(len(names.dictionary), 1) + name, return_index=True, return_inverse=True)
        self.pair_of_ref = ref_pair[self.first_ref]
        words = pa.concat_arrays([hyp_tokens.flatten(), ref_tokens.flatten()]).dictionary_encode(null_encoding="encode")
        self.words, self.word = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.concatenate([_lengths(hyp_tokens), _lengths(ref_tokens)])
        self.owner = np.repeat(np.concatenate([hyp_pair, ref_owner]), lengths)
        self.left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(self.word))
        self.n_hyp = len(hyp_tokens.flatten())

    def orders(self, max_n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """n, the places with a gram of n words, their grams' numbers, and a place of each gram."""
        at, gram = np.arange(len(self.word)), self.word
        for n in range(1, max_n + 1):
            inside = self.left[at] >= n
            at, key = at[inside], gram[inside] * max(len(self.words), 1) + self.word[at[inside] + n - 1] if n > 1 else gram
            _, first, gram = np.unique(key, return_index=True, return_inverse=True)
            if not len(at):
                return
            yield n, at, gram, at[first]


def _matched(places: _Places, min_n: int, max_n: int, best: bool) -> Iterator[tuple]:
    """n, and of each matched gram of each reference: the reference, a place of the gram, the matches.

    With `best`, a gram has the count of the reference that has it most, and the pair's first reference stands for all.
    """
    for n, at, gram, first in places.orders(max_n):
        if n < min_n:
            continue
        is_hyp = at < places.n_hyp
        pair, mine, count = _counted(places.owner[at[is_hyp]], gram[is_hyp], len(first))
        ref, theirs, most = _counted(places.owner[at[~is_hyp]], gram[~is_hyp], len(first))
        if not len(pair) or not len(ref):
            continue
        have, asked = pair * len(first) + mine, places.pair_of_ref[ref] * len(first) + theirs
        if best:
            order = np.argsort(asked, kind="stable")
            starts = np.flatnonzero(np.diff(asked[order], prepend=-1))
            ref, theirs, asked, most = ref[order][starts], theirs[order][starts], asked[order][starts], np.maximum.reduceat(most[order], starts)
        spot = np.minimum(np.searchsorted(have, asked), len(have) - 1)
        same = have[spot] == asked
        yield n, ref[same], first[theirs[same]], np.minimum(most[same], count[spot[same]])


def _named(part: pa.RecordBatch, places: _Places, ref: np.ndarray, n: int) -> list[pa.Array]:
    return [
        part.column("pair").take(pa.array(places.pair_of_ref[ref])),
        places.ref.take(pa.array(places.first_ref[ref])),
        pa.array(np.full(len(ref), n), pa.int32()),
    ]


def _over_pairs(hyps: DataFrame, refs: DataFrame, rows_of, more: list[tuple[str, T.DataType]]) -> DataFrame:
    pairs = _side_by_side(hyps, refs)
    schema = T.StructType([hyps.schema["pair"], refs.schema["ref"], T.StructField("n", T.IntegerType())])
    for name, kind in more:
        schema = schema.add(name, kind)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for columns in rows_of(batch.slice(at, ROWS)):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return pairs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def match_counts(hyps: DataFrame, refs: DataFrame, min_n: int, max_n: int, best: bool = False) -> DataFrame:
    """pair, ref, n, hit: clipped matches of each order, where there are any.

    With `best`, a gram counts as often as the reference has it that has it most, and matches are given by pair only.
    """

    def rows_of(part: pa.RecordBatch) -> Iterator[list[pa.Array]]:
        places = _Places(part)
        for n, ref, _, hit in _matched(places, min_n, max_n, best):
            found, back = np.unique(places.pair_of_ref[ref] if best else ref, return_inverse=True)
            total = np.bincount(back, weights=hit, minlength=len(found)).astype(np.int64)
            shown = np.searchsorted(places.pair_of_ref, found) if best else found
            yield [*_named(part, places, shown, n), pa.array(total)]

    return _over_pairs(hyps, refs, rows_of, [("hit", T.LongType())])


def matched_grams(hyps: DataFrame, refs: DataFrame, min_n: int, max_n: int) -> DataFrame:
    """pair, ref, n, gram, hit: every gram that a reference shares, its words joined by the separator."""

    def rows_of(part: pa.RecordBatch) -> Iterator[list[pa.Array]]:
        places = _Places(part)
        for n, ref, place, hit in _matched(places, min_n, max_n, False):
            words = [places.words.take(pa.array(places.word[place + k])).cast(pa.string()) for k in range(n)]
            gram = pc.binary_join_element_wise(*words, SEPARATOR, null_handling="skip")
            yield [*_named(part, places, ref, n), gram, pa.array(hit.astype(np.int64))]

    return _over_pairs(hyps, refs, rows_of, [("gram", T.StringType()), ("hit", T.LongType())])
