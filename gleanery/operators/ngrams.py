"""N-grams cut inside the row of their text: no shuffle before the first count."""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def padded(tokens: Column, n: int, left: str | None = None, right: str | None = None) -> Column:
    """n - 1 marks at either end, where a mark is given."""
    parts = [tokens]
    if left is not None:
        parts.insert(0, F.array_repeat(F.lit(left), n - 1))
    if right is not None:
        parts.append(F.array_repeat(F.lit(right), n - 1))
    return F.concat(*parts)


def side_by_side(length: Column, offsets: tuple[int, ...], tokens: str = "_t") -> Column:
    """The tokens at each of the offsets from the first `length` positions, as one struct (w1, w2, …) a position.

    Slices of the array next to each other, which generated code builds; a lambda would be interpreted at every position.
    """
    names = ", ".join(f"w{j + 1}: string" for j in range(len(offsets)))
    parts = [F.slice(F.col(tokens), F.lit(o + 1), length) for o in offsets]
    return F.arrays_zip(*parts).cast(f"array<struct<{names}>>")


def _at_offsets(tokens: str, offsets: tuple[int, ...]) -> Column:
    """One struct (w1, w2, …) per position that has all the offsets."""
    return side_by_side(F.greatest(F.size(tokens) - offsets[-1], F.lit(0)), offsets, tokens)


def ngrams(
    texts: DataFrame, tokens: Column, n: int, keep: list[str] = [],
    left: str | None = None, right: str | None = None,
) -> DataFrame:
    """Columns w1 … wn, one row per n-gram of every text."""
    rows = texts.select(*keep, padded(tokens, n, left, right).alias("_t"))
    return rows.select(*keep, F.inline(_at_offsets("_t", tuple(range(n)))))


def everygrams(
    texts: DataFrame, tokens: Column, min_n: int, max_n: int, keep: list[str] = [],
    left: str | None = None, right: str | None = None,
) -> DataFrame:
    """All n-grams of min_n to max_n words as (n, gram)."""
    rows = texts.select(*keep, padded(tokens, max_n, left, right).alias("_t"))

    places = side_by_side(F.size("_t"), tuple(range(max_n)))
    left = F.when(F.size("_t") > 0, F.sequence(F.size("_t"), F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    spots = rows.select(*keep, F.inline(F.arrays_zip(left.alias("left"), places.alias("words")))).toDF(*keep, "_left", "_words")
    grams = [
        F.struct(
            F.lit(n).alias("n"),
            F.when(F.col("_left") >= n, F.concat_ws(" ", *[F.col("_words")[f"w{j + 1}"] for j in range(n)])).alias("gram"),
        )
        for n in range(min_n, max_n + 1)
    ]
    return spots.select(*keep, F.inline(F.array(*grams))).where("gram IS NOT NULL")


def skipgrams(texts: DataFrame, tokens: Column, n: int, k: int, keep: list[str] = []) -> DataFrame:
    """n-grams that may leave out up to k words in all."""
    rows = texts.select(*keep, tokens.alias("_t"))
    shapes = [(0, *tail) for tail in combinations(range(1, n + k), n - 1)]
    return rows.select(*keep, F.inline(F.concat(*[_at_offsets("_t", s) for s in shapes])))


def gram_counts(grams: DataFrame, columns: list[str]) -> DataFrame:
    return grams.groupBy(*columns).agg(F.count("*").alias("n"))
