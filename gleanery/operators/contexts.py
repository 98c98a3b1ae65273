"""Words in context: concordance, shared contexts, distributional similarity, tf-idf."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.sources.tables import ensure_checkpoint_dir

START, END = "*START*", "*END*"


def word_contexts(texts: DataFrame, tokens: Column) -> DataFrame:
    """(word, left, right) with its count, over neighbours inside each text."""
    rows = texts.select(tokens.alias("_t"))
    # Slices side by side, which generated code builds; a lambda would be interpreted at every word.
    n = F.size("_t")
    spots = F.arrays_zip(
        F.col("_t"),
        F.slice(F.concat(F.array(F.lit(START)), F.col("_t")), F.lit(1), n),
        F.slice(F.concat(F.col("_t"), F.array(F.lit(END))), F.lit(2), n),
    ).cast("array<struct<word:string,left:string,right:string>>")
    return rows.select(F.inline(spots)).groupBy("word", "left", "right").agg(F.count("*").alias("n"))


def _own(contexts: DataFrame, word: str, value: Column) -> DataFrame:
    """The contexts of one word, written to the shared folder once, so that no later step goes through the texts for them."""
    ensure_checkpoint_dir(contexts.sparkSession)
    return contexts.where(F.col("word") == word).select("left", "right", value).checkpoint()


def similar_words(contexts: DataFrame, word: str, k: int = 20) -> DataFrame:
    """The words that share most contexts with the given one.

    Only the contexts of that one word are joined with, never every word with every other.
    """
    own = _own(contexts, word, F.col("n").alias("n_own"))
    shared = contexts.where(F.col("word") != word).join(own, ["left", "right"])
    return (
        shared.groupBy("word")
        .agg(F.count("*").alias("n_shared"), F.sum(F.col("n") * F.col("n_own")).alias("weight"))
        .orderBy(F.desc("n_shared"), F.asc("word"))
        .limit(k)
    )


def word_similarity(contexts: DataFrame, word: str) -> DataFrame:
    """F-measure of every word's set of contexts against the given word's set."""
    own = _own(contexts, word, F.lit(1).alias("hit"))
    n_own = own.agg(F.count("*")).scalar()
    sets = contexts.join(own, ["left", "right"], "left").groupBy("word").agg(
        F.count("*").alias("n_contexts"), F.count("hit").alias("n_shared")
    )
    # 2pr / (p + r) with p = shared / other set and r = shared / own set.
    return sets.where("n_shared > 0").select(
        "word", "n_shared", (2.0 * F.col("n_shared") / (F.col("n_contexts") + n_own)).alias("f")
    )


def common_contexts(contexts: DataFrame, words: list[str]) -> DataFrame:
    """Contexts in which each of the words occurs, with the occurrences of all of them."""
    wanted = sorted(set(words))
    return (
        contexts.where(F.col("word").isin(wanted))
        .groupBy("left", "right")
        .agg(F.count("*").alias("n_words"), F.sum("n").alias("n"))
        .where(F.col("n_words") == len(wanted))
        .select("left", "right", "n")
    )


def concordance(
    texts: DataFrame, key: str, tokens: Column, phrase: list[str], width: int = 80
) -> DataFrame:
    """Every occurrence of the phrase with its neighbourhood, cut to `width` characters a line."""
    text = " ".join(phrase)
    half = (width - len(text) - 2) // 2
    around = width // 4
    n = len(phrase)
    rows = texts.select(key, tokens.alias("_t"))
    last = F.size("_t") - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def matches(i: Column) -> Column:
        hit = F.lit(True)
        for j, word in enumerate(phrase):
            hit = hit & (F.get(F.col("_t"), i + j) == word)
        return hit

    hits = rows.select(key, "_t", F.explode(F.filter(starts, matches)).alias("offset"))
    i = F.col("offset")
    left = F.array_join(F.slice("_t", F.greatest(i - around, F.lit(0)) + 1, F.least(i, F.lit(around))), " ")
    right = F.array_join(F.slice("_t", i + n + 1, F.lit(max(around - n, 0))), " ")
    cut_left = F.lpad(F.expr("right(l, {0})".format(half)), half, " ")
    return (
        hits.withColumns({"l": left, "r": right})
        .select(
            key,
            "offset",
            cut_left.alias("left_print"),
            F.lit(text).alias("query"),
            F.substring("r", 1, half).alias("right_print"),
        )
        .withColumn("line", F.concat_ws(" ", "left_print", "query", "right_print"))
    )


def tf_idf(doc_terms: DataFrame, lengths: DataFrame, n_texts: Column, key: str) -> DataFrame:
    """tf = count / text length, idf = ln(texts / texts with the term)."""
    df = doc_terms.groupBy("term").agg(F.count("*").alias("df"))
    return (
        doc_terms.join(lengths, key)
        .join(df, "term")
        .select(
            key,
            "term",
            (F.col("tf") / F.col("n_tokens")).alias("tf"),
            F.log(n_texts / F.col("df")).alias("idf"),
        )
        .withColumn("tf_idf", F.col("tf") * F.col("idf"))
    )
