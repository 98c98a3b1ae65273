"""Top terms per category, the merged dictionary and their text form."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 75


def top_terms(scores: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The k best terms of each category, ties by term.

    `row_number() <= k` lets every task keep k rows per category before the shuffle,
    so a category with most of the vocabulary costs no more than the others.
    """
    order = Window.partitionBy("category").orderBy(F.desc("chi2"), F.asc("term"))
    return (
        scores.select("category", "term", "chi2")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def merged_dictionary(top: DataFrame) -> DataFrame:
    return top.select("term").distinct()


def ranked_lines(top: DataFrame) -> DataFrame:
    """`category t1:score … tk:score` per line, categories ascending, then the dictionary line."""
    # Half-even before formatting: Java's formatter alone rounds exact halves up.
    entry = F.format_string("%s:%.4f", F.col("term"), F.bround("chi2", 4))
    by_category = top.groupBy("category").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), entry.alias("entry")))).alias("entries")
    )
    lines = by_category.select(
        F.lit(0).alias("part"),
        "category",
        F.concat_ws(" ", "category", F.array_join(F.col("entries.entry"), " ")).alias("line"),
    )
    words = merged_dictionary(top).agg(
        F.array_join(F.sort_array(F.collect_list("term")), " ").alias("line")
    )
    last = words.select(F.lit(1).alias("part"), F.lit("").alias("category"), "line")
    return lines.unionByName(last)
