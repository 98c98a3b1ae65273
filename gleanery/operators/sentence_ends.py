"""Sentence ends with abbreviations learned from the corpus itself (Kiss and Strunk, 2006).

A word that is an abbreviation nearly always has a full stop behind it, is short, and may hold full stops. One pass counts every
word type with and without a stop; the log-likelihood ratio of "the stop belongs to the word" against "stops fall
by chance", weighed by length, inner stops and the times the word stands without one, is its score. A type is a run of letters
and full stops that starts with a letter, in lower case; a run with several stops at its end counts as one without.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.words import BLANKS, CLOSERS, MARK

# Fixed values of the method: chance of a stop behind an abbreviation, least score, and the guard of the logarithms.
CHANCE = 0.99
LEAST_SCORE = 0.3
GUARD = 1e-8

RUN = r"\p{L}[\p{L}.]*"


def word_ends(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, with_stop, without_stop: how often each type has a full stop behind it."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({RUN})"), F.lit(1))
    rows = docs.select(F.explode(runs).alias("run"))
    stopped = F.col("run").rlike(r"[^.]\.$")
    return rows.groupBy(F.rtrim(F.col("run"), F.lit(".")).alias("word")).agg(
        F.count_if(stopped).alias("with_stop"), F.count_if(~stopped).alias("without_stop")
    )


def abbreviations(ends: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The types of `word_ends` that score `least` or more, with their counts and scores."""
    n, stops = F.col("with_stop") + F.col("without_stop"), F.col("with_stop")
    whole = ends.agg(F.sum(stops).cast("double").alias("stops"), F.sum(n).cast("double").alias("n"))
    chance = whole.select(F.col("stops") / F.col("n")).scalar()

    def logs(p: Column) -> Column:
        return stops * F.log(p) + F.col("without_stop") * F.log(1 - p + F.lit(GUARD))

    inner = F.length(F.regexp_replace("word", r"[^.]", ""))
    letters = F.length("word") - inner
    ratio = -2 * (logs(F.col("chance")) - logs(F.lit(CHANCE)))
    penalty = F.pow(letters.cast("double"), -F.col("without_stop").cast("double"))
    score = ratio * F.exp(-letters.cast("double")) * (inner + 1) * penalty
    scored = ends.where("with_stop > 0").withColumn("chance", chance).withColumn("score", score)
    return scored.where(F.col("score") >= least).select("word", "with_stop", "without_stop", "score")


def split(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pos, sentence. A cut behind a full stop is taken back if the word in front of it is in `known` (column word).

    Texts are cut everywhere first; the pieces look up their last words, join the next piece where that is known, and come
    together again by `key`, which must tell texts apart.
    """
    body = F.trim(F.coalesce(F.col(text), F.lit("")))
    cut = F.regexp_replace(body, f"(?U)([.!?]{CLOSERS}{BLANKS}+)", f"$1{MARK}")
    pieces = docs.select(F.col(key).alias("key"), F.posexplode(F.split(cut, MARK)).alias("place", "piece"))
    last = F.regexp_extract(F.lower("piece"), rf"({RUN})\.{CLOSERS}{BLANKS}*$", 1)
    words = known.select(F.col("word").alias("last"), F.lit(True).alias("open"))
    looked_up = pieces.withColumn("last", last).join(words, "last", "left")
    whole = looked_up.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "open"))).alias("pieces"))
    kinds = "struct<done:array<string>,rest:string>"

    def step(state: Column, p: Column) -> Column:
        grown = F.concat(state["rest"], p["piece"])
        going_on = F.struct(state["done"].alias("done"), grown.alias("rest")).cast(kinds)
        ended = F.struct(F.array_append(state["done"], grown).alias("done"), F.lit("").alias("rest")).cast(kinds)
        return F.when(p["open"], going_on).otherwise(ended)

    start = F.struct(F.array().alias("done"), F.lit("").alias("rest")).cast(kinds)
    found = F.aggregate("pieces", start, step, lambda s: F.array_append(s["done"], s["rest"]))
    bare = F.transform(found, lambda s: F.regexp_replace(s, f"(?U){BLANKS}+$", ""))
    return whole.select(F.col("key").alias(key), F.posexplode(F.filter(bare, lambda s: s != "")).alias("pos", "sentence"))
