"""Language identification by the ranks of character trigrams."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.row_items import ROWS
from gleanery.sources.tables import ensure_checkpoint_dir

START, END = "<", ">"


def _marked(text: Column) -> Column:
    """The words side by side as <one><two>."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+", END + START)
    return F.concat(F.lit(START), words, F.lit(END))


def _counted(marked: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct letter trigrams of words with their end marks, most frequent first, ties by code point; and their counts.

    A trigram is any three characters with no end mark before its last place and no start mark after its first.
    """
    c = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.int64)
    first, second, third = c[:-2], c[1:-1], c[2:]
    start, end = ord(START), ord(END)
    inside = (first != end) & (second != start) & (second != end) & (third != start)
    packed, n = np.unique((first << 42 | second << 21 | third)[inside], return_counts=True)
    order = np.lexsort((packed, -n))
    packed = packed[order]
    letters = np.stack([packed >> 42, packed >> 21 & 0x1FFFFF, packed & 0x1FFFFF], axis=1).astype("<u4")
    return letters.view("<U3").ravel(), n[order]


def trigram_counts(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep, place, trigram, n: each text's distinct trigrams in order of frequency, counted within its row."""
    rows = documents.select(*keep, _marked(F.col(text)).alias("_marked"))
    schema = rows.select(*keep).schema.add("place", T.IntegerType()).add("trigram", T.StringType()).add("n", T.LongType())
    names = schema.names

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found, counts = zip(*[_counted(m) for m in part.column(len(keep)).to_pylist()])
                sizes = [len(f) for f in found]
                row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                place = np.concatenate([np.arange(k, dtype="int32") for k in sizes])
                columns = [part.column(i).take(row) for i in range(len(keep))]
                columns += [pa.array(place), pa.array(np.concatenate(found).astype(object), pa.string()), pa.array(np.concatenate(counts).astype("int64"))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(counted, schema)


def profiles(
    labelled: DataFrame, text: str = "text", language: str = "lang", size: int | None = None
) -> DataFrame:
    """The trigrams of each language with their rank by frequency, from 0; all of them, or the `size` first."""
    counts = (
        trigram_counts(labelled.select(F.col(language).alias("language"), F.col(text).alias("text")), ["language"])
        .groupBy("language", "trigram")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("language").orderBy(F.desc("n"), F.asc("trigram"))
    placed = counts.withColumn("place", F.row_number().over(by_count))
    if size is not None:
        placed = placed.where(F.col("place") <= size)
    return placed.select("language", "trigram", (F.col("place") - 1).alias("rank"))


def ranked_trigrams(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """A text's distinct trigrams in order of frequency; counted and ranked within its row."""
    return trigram_counts(documents, [key], text).select(key, "place", "trigram")


def distances(documents: DataFrame, profile: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Per text and language: trigrams the language lacks, and how far the others are out of place."""
    return (
        ranked_trigrams(documents, key, text)
        .join(profile, "trigram")
        .groupBy(key, "language")
        .agg(
            F.count("*").alias("n_found"),
            F.sum(F.abs(F.col("rank") - F.col("place"))).alias("out_of_place"),
        )
    )


def guess(documents: DataFrame, profile: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The language that lacks fewest trigrams, then the least out of place, then by name.

    A missing trigram weighs more than any displacement, so the two never need adding up. A text without a known
    trigram lacks as many for every language, so its guess is the first by name. The profile, which is read twice, is written
    to the shared folder once.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    profile = profile.checkpoint()
    best = F.min(F.struct((-F.col("n_found")).alias("m"), "out_of_place", "language")).alias("best")
    found = distances(documents, profile, key, text).groupBy(key).agg(best)
    first = profile.agg(F.min("language")).scalar()
    return (
        documents.select(key).join(found, key, "left").select(key, F.coalesce("best.language", first).alias("guess"))
    )
