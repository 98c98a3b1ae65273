"""Texts packed into blocks, for steps in which every word of a corpus has to meet something or be counted with its neighbours.

A block is one row with whole texts of some TOKENS words: its distinct words, how often it has each, and its texts as places in
that list. What depends on the word alone meets the distinct words of a block and not each of its texts. Lists of whole
numbers travel as compressed bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.sources.tables import ensure_checkpoint_dir

#: Words (and texts) in a block, about; a longer text is a block by itself. Bounds what a task holds.
TOKENS = 1_000_000


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, the first bytes of all of them, then the second ones, and so on."""
    planes = np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, kind: type = np.int32) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.Codec("zstd").decompress(data[8:], n * width, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).ravel()


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _cut(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of at most so many words and rows, or of one row."""
    ends, first = np.cumsum(_lengths(batch.column(0)) + 1), 0
    while first < len(batch):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(number: int, pieces: list[pa.RecordBatch], names: list[str]) -> pa.RecordBatch:
    lists = pa.concat_arrays([p.column(0) for p in pieces])
    coded = lists.flatten().dictionary_encode()
    known = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    codes = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
    times = np.bincount(codes[known], minlength=len(coded.dictionary))
    # Frequent words come first, which leaves small numbers to compress.
    order = np.argsort(-times, kind="stable")
    rank = np.zeros(max(len(order), 1), np.int32)
    rank[order] = np.arange(len(order))
    places = np.where(known, rank[codes], -1).astype(np.int32)
    columns = [
        pa.array([number], pa.int64()), pa.array([int(known.sum())], pa.int64()), _listed(coded.dictionary.take(pa.array(order))),
        _listed(pa.array(times[order].astype("int32"))), pa.array([packed(_lengths(lists).astype(np.int32))], pa.binary()), pa.array([packed(places)], pa.binary()),
    ]
    columns += [_listed(pa.concat_arrays([p.column(i) for p in pieces])) for i in range(1, pieces[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def unstored(texts: DataFrame, tokens: Column, keep: list[str] = []) -> DataFrame:
    """`blocks` that are made anew whenever they are read."""
    rows = texts.select(tokens.alias("_t"), *keep)
    fields = [
        ("block", T.LongType()), ("size", T.LongType()), ("words", T.ArrayType(T.StringType())), ("times", T.ArrayType(T.IntegerType())),
        ("lengths", T.BinaryType()), ("places", T.BinaryType()), *[(k, T.ArrayType(rows.schema[k].dataType)) for k in keep],
    ]
    most, names = TOKENS, [name for name, _ in fields]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for piece in _cut(batch, most):
                more = int(_lengths(piece.column(0)).sum()) + len(piece)
                if held and size + more > most:
                    yield _block(number, held, names)
                    number, held, size = number + 1, [], 0
                held.append(piece)
                size += more
        if held:
            yield _block(number, held, names)

    return rows.mapInArrow(made, T.StructType([T.StructField(name, kind) for name, kind in fields]))


def blocks(texts: DataFrame, tokens: Column, keep: list[str] = []) -> DataFrame:
    """block, size (in words), words, times, lengths (of the texts), places; and a list of each column to keep. A null token has place -1.

    The texts are cut into words once; the blocks lie in the shared folder.
    """
    ensure_checkpoint_dir(texts.sparkSession)
    return unstored(texts, tokens, keep).checkpoint()


def word_counts(packs: DataFrame) -> DataFrame:
    """word, n: every word of the blocks and how often they have it."""
    listed = packs.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))))
    return listed.groupBy("word").agg(F.sum("times").alias("n"))


def numbered(counts: DataFrame, least: int = 1) -> DataFrame:
    """word, number, n: the words found at least so often, from 1, the most frequent first.

    The sorted words are checkpointed; a word's number is its place in its partition plus the sizes of those before.
    """
    ordered = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    placed = ordered.withColumn("_part", F.shiftright("_row", 33)).withColumn("_place", F.col("_row").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_size")).select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select("word", (F.col("_start") + F.col("_place") + 1).cast("int").alias("number"), "n")


def encoded(packs: DataFrame, numbers: DataFrame) -> DataFrame:
    """lengths, numbers: the blocks' texts as the numbers of their words, 0 for a word without one."""
    met = (
        packs.select("block", F.posexplode("words").alias("place", "word"))
        .join(numbers.select("word", "number"), "word")
        .select("block", "place", "number")
    )

    def named(own: pa.Table, met: pa.Table) -> pa.Table:
        if not len(own):
            return pa.table({"lengths": pa.array([], pa.binary()), "numbers": pa.array([], pa.binary())})
        # The last one is that of a null token's place, -1.
        found = np.zeros(own.column("n_words")[0].as_py() + 1, np.int32)
        found[met.column("place").to_numpy()] = met.column("number").to_numpy()
        texts = packed(found[unpacked(own.column("places")[0].as_py())])
        return pa.table({"lengths": own.column("lengths"), "numbers": pa.array([texts], pa.binary())})

    own = packs.select(F.col("block").alias("own"), F.size("words").alias("n_words"), "lengths", "places")
    return own.groupBy("own").cogroup(met.groupBy("block")).applyInArrow(named, "lengths binary, numbers binary")


def counts_after(packs: DataFrame, marks: list[str]) -> DataFrame:
    """word, n, n_after: how often there is a word, and how often right after one of the marks; texts, texts_after, texts_other:
    how many texts have it at all, there, and elsewhere."""
    names = ["n", "n_after", "texts", "texts_after", "texts_other"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, lengths, places in zip(*(batch.column(i) for i in range(3))):
                words, lengths, places = words.values, unpacked(lengths.as_py()), unpacked(places.as_py())
                # The last one is that of a null token's place, -1.
                marked = np.append(pc.is_in(words, value_set=pa.array(marks, pa.string())).to_numpy(zero_copy_only=False), False)
                after = np.zeros(len(places), bool)
                after[1:] = marked[places[:-1]]
                after[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
                row, n, known = np.repeat(np.arange(len(lengths)), lengths), max(len(words), 1), places >= 0

                def texts(where: np.ndarray) -> np.ndarray:
                    return np.bincount(np.unique(row[where] * n + places[where]) % n, minlength=n)

                found = [np.bincount(places[known], minlength=n), np.bincount(places[known & after], minlength=n)]
                found += [texts(known), texts(known & after), texts(known & ~after)]
                yield pa.RecordBatch.from_arrays([words, *[pa.array(c[: len(words)], pa.int64()) for c in found]], names=["word", *names])

    schema = ", ".join(["word string", *[f"{name} long" for name in names]])
    return packs.select("words", "lengths", "places").mapInArrow(counted, schema).groupBy("word").agg(*[F.sum(name).alias(name) for name in names])
