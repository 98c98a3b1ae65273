"""Shards along a Hilbert curve over document metadata, in DataFrame operations only.

Each dimension is quantised to `bits` bits, the cell's index on the curve orders the documents, and the order is cut
into runs of equal counts. Neighbours on the curve are alike in every dimension, so a shard's ranges are narrow and
files can be skipped by any of them. String dimensions are quantised by their rank among the distinct values, lengths
by their logarithm. Nulls are the last value of a dimension. Ties on the curve are ordered by id, then by text hash.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.frames import kept, ranked

BITS = 8


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index of a cell on the Hilbert curve, by Skilling's transposition (AIP Conf. Proc. 707, 2004)."""
    n = len(cells)
    start = F.array(*[c.cast("long") for c in cells])
    masks = [1 << b for b in range(bits - 1, 0, -1)]
    steps = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in masks for i in range(n)])

    def undo(x: Column, step: Column) -> Column:
        low = step["q"] - 1
        first, mine = F.get(x, F.lit(0)), F.get(x, step["i"])
        swap = first.bitwiseXOR(mine).bitwiseAND(low)
        on = mine.bitwiseAND(step["q"]) != 0
        return F.transform(
            x,
            lambda v, j: F.when(j == 0, F.when(on, v.bitwiseXOR(low)).otherwise(v.bitwiseXOR(swap)))
            .when((j == step["i"]) & ~on, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    def gray(x: Column) -> Column:
        return F.aggregate(
            x,
            F.array().cast("array<long>"),
            lambda done, v: F.concat(done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))),
        )

    def turned(x: Column) -> Column:
        turn = F.aggregate(
            F.array(*[F.lit(q).cast("long") for q in masks]),
            F.lit(0).cast("long"),
            lambda t, q: F.when(F.get(x, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return F.transform(F.array(turn), lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))[0]

    def woven(x: Column) -> Column:
        places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
        zero = F.lit(0).cast("long")
        one = F.lit(1).cast("long")
        return F.aggregate(
            places,
            zero,
            lambda h, p: h * 2
            + F.when(F.get(x, p["i"]).bitwiseAND(F.pow(F.lit(2.0), p["b"]).cast("long")) != 0, one).otherwise(zero),
        )

    coded = F.transform(F.array(F.aggregate(steps, start, undo)), gray)
    return F.transform(F.transform(coded, turned), woven)[0]


def by_rank(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Add `<column>_cell`: the rank of a value among the distinct ones, scaled to 2^bits cells; null comes last."""
    values = ranked(df.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct(), "_value")
    n = values.count()
    scaled = F.floor(F.col("rank") * float(1 << bits) / max(n, 1)).cast("long")
    cells = values.select("_value", scaled.alias("_cell"))
    cell = F.coalesce("_cell", F.lit((1 << bits) - 1)).alias(f"{column}_cell")
    return df.join(cells, df[column] == F.col("_value"), "left").select(*df.columns, cell)


def by_log(value: Column, bits: int = BITS) -> Column:
    """Cells of equal width in the logarithm of a count below 2^32."""
    scaled = F.floor(F.log2(value.cast("double") + 1) * ((1 << bits) / 32.0)).cast("long")
    return F.least(scaled, F.lit((1 << bits) - 1))


def sharded(docs: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, size, text_crc32, index, shard, slot; shards' counts differ by one at most."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = kept(
        docs.select(
            key,
            "source",
            "lang",
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            by_log(F.length(body)).alias("length_cell"),
        )
    )
    cells = by_rank(by_rank(narrow, "source"), "lang")
    index = curve_index([F.col("source_cell"), F.col("lang_cell"), F.col("length_cell")])
    indexed = cells.select(key, "size", "text_crc32", index.alias("index"))
    n = narrow.count()
    return (
        ranked(indexed, "index", key, "text_crc32")
        .withColumn("shard", F.expr(f"CAST(rank * {n_shards} DIV {max(n, 1)} AS INT)"))
        .withColumn("slot", F.expr(f"rank - (CAST(shard AS LONG) * {n} + {n_shards - 1}) DIV {n_shards}"))
        .drop("rank")
    )
