"""Document-frequency tables and chi-square scores per (term, category)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.tokenize import token_set


def countable(reviews: DataFrame) -> DataFrame:
    """Reviews with a category; the others take no part in any count."""
    return reviews.where("category is not null and category <> ''")


def category_sizes(reviews: DataFrame) -> DataFrame:
    """Documents per category, before any token is looked at."""
    return countable(reviews).groupBy("category").agg(F.count("*").alias("n_c"))


def corpus_size(reviews: DataFrame) -> Column:
    """Number of counted documents as a scalar subquery: one row, never a join."""
    return countable(reviews).agg(F.count("*").alias("n")).scalar()


def corpus_sizes(reviews: DataFrame) -> DataFrame:
    """Category sizes and the corpus size from one aggregate; the corpus row has a null category."""
    return countable(reviews).rollup("category").agg(F.count("*").alias("n_docs"))


def drop_stop_words(terms: DataFrame, stop_words: DataFrame | None) -> DataFrame:
    if stop_words is None:
        return terms
    return terms.join(stop_words.select(F.col("word").alias("term")), "term", "left_anti")


def review_terms(
    reviews: DataFrame,
    stop_words: DataFrame | None = None,
    tokenizer: str = "unicode",
    keep: tuple[str, ...] = ("category",),
) -> DataFrame:
    """One row per review and distinct term."""
    exploded = countable(reviews).select(
        *keep, F.explode(token_set(F.col("reviewText"), tokenizer)).alias("term")
    )
    return drop_stop_words(exploded, stop_words)


def term_category_counts(
    reviews: DataFrame, stop_words: DataFrame | None = None, tokenizer: str = "unicode"
) -> DataFrame:
    """a = documents of the category that hold the term."""
    return (
        review_terms(reviews, stop_words, tokenizer)
        .groupBy("term", "category")
        .agg(F.count("*").alias("a"))
    )


def term_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("a").alias("f_t"))


def term_statistics(counts: DataFrame) -> DataFrame:
    """Per term the total and a category -> count map (at most one entry per category)."""
    return counts.groupBy("term").agg(
        F.sum("a").alias("total"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "a")))).alias("categories"),
    )


def count_records(counts: DataFrame, reviews: DataFrame) -> DataFrame:
    """Term, category and corpus counts as one tagged table."""
    by_term = counts.select(
        F.lit("t").alias("kind"), "term", "category", F.col("a").alias("cnt")
    )
    by_category = corpus_sizes(reviews).select(
        F.when(F.col("category").isNull(), "n").otherwise("c").alias("kind"),
        F.lit(None).cast("string").alias("term"),
        "category",
        F.col("n_docs").alias("cnt"),
    )
    return by_term.unionByName(by_category)


def contingency(counts: DataFrame, sizes: DataFrame, n: Column) -> DataFrame:
    """The four cells a, b, c, d of every (term, category) table.

    `counts` holds one row per term and category, so a term's window never exceeds the
    number of categories.
    """
    total = F.sum("a").over(Window.partitionBy("term"))
    return (
        counts.withColumn("f_t", total)
        .join(sizes, "category")
        .withColumn("n", n)
        .select(
            "term",
            "category",
            "n",
            "a",
            (F.col("f_t") - F.col("a")).alias("b"),
            (F.col("n_c") - F.col("a")).alias("c"),
            (F.col("n") - F.col("n_c") - F.col("f_t") + F.col("a")).alias("d"),
        )
    )


def chi2_closed(cells: DataFrame) -> DataFrame:
    """n(ad-bc)^2 / ((a+b)(a+c)(b+d)(c+d)); pairs with an empty margin are dropped.

    Products pass 2^63 long before the corpus is large, so they are taken in double.
    """
    a, b, c, d = (F.col(x) for x in "abcd")
    diff = a.cast("double") * d - b.cast("double") * c
    margins = (
        (a + b).cast("double")
        * (a + c).cast("double")
        * (b + d).cast("double")
        * (c + d).cast("double")
    )
    return (
        cells.withColumn("den", margins)
        .where("den > 0")
        .select(
            "term",
            "category",
            "a",
            "b",
            "c",
            "d",
            (F.col("n").cast("double") * diff * diff / F.col("den")).alias("chi2"),
        )
    )


def chi2_expected(cells: DataFrame) -> DataFrame:
    """Sum of (observed-expected)^2 / expected; cells expected to be empty add nothing."""
    n = F.col("n").cast("double")
    rows = {"in": F.col("a") + F.col("c"), "out": F.col("b") + F.col("d")}
    cols = {"with": F.col("a") + F.col("b"), "without": F.col("c") + F.col("d")}

    def part(observed: str, row: str, col: str) -> Column:
        expected = rows[row].cast("double") * cols[col].cast("double") / n
        gap = F.col(observed).cast("double") - expected
        return F.when(expected > 0, gap * gap / expected).otherwise(F.lit(0.0))

    score = (
        part("a", "in", "with")
        + part("b", "out", "with")
        + part("c", "in", "without")
        + part("d", "out", "without")
    )
    return cells.where("a + c > 0 and least(a, b, c, d) >= 0").select(
        "term", "category", "a", "b", "c", "d", score.alias("chi2")
    )


def chi2_scores(
    reviews: DataFrame,
    stop_words: DataFrame | None = None,
    tokenizer: str = "unicode",
    form: str = "closed",
) -> DataFrame:
    """Scan, tokenise, count and score in one plan.

    The texts are read once; the corpus size is the sum of the category sizes, which need only the categories.
    """
    sizes = category_sizes(reviews)
    n = sizes.agg(F.sum("n_c")).scalar()
    cells = contingency(term_category_counts(reviews, stop_words, tokenizer), sizes, n)
    return chi2_closed(cells) if form == "closed" else chi2_expected(cells)
