"""Most-frequent-tag models: learned by counting, applied by joins, with back-off."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_TAG = "NN"


def best_tag(events: DataFrame, context: list[str], cutoff: int = 0, times: str | None = None) -> DataFrame:
    """The most frequent tag of each context seen more than `cutoff` times with it; ties by tag.

    An event is one row, or stands for as many as its column `times` says.

    Counting comes first, so a context with most of the corpus is a handful of rows when
    its tags are compared.
    """
    counts = events.groupBy(*context, "tag").agg((F.count("*") if times is None else F.sum(times)).alias("n"))
    first = Window.partitionBy(*context).orderBy(F.desc("n"), F.asc("tag"))
    return (
        counts.withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .where(F.col("n") > cutoff)
        .select(*context, "tag", "n")
    )


def useful(events: DataFrame, context: list[str], backoff_tag: Column) -> DataFrame:
    """Contexts that the back-off gets wrong at least once."""
    return events.where(F.col("tag") != backoff_tag).select(*context).distinct()


def train_unigram(tagged: DataFrame, cutoff: int = 0, times: str | None = None) -> DataFrame:
    return best_tag(tagged.select("word", "tag", *([times] if times else [])), ["word"], cutoff, times)


def affix(word: Column, length: int, min_stem: int = 2) -> Column:
    """A suffix of `-length` characters, or a prefix; null when the stem would be too short."""
    n = abs(length)
    part = F.substring(word, -n, n) if length < 0 else F.substring(word, 1, n)
    return F.when(F.length(word) >= n + min_stem, part)


def train_affix(tagged: DataFrame, length: int = -3, min_stem: int = 2, cutoff: int = 0) -> DataFrame:
    events = tagged.select(affix(F.col("word"), length, min_stem).alias("affix"), "tag")
    return best_tag(events.where("affix is not null"), ["affix"], cutoff)


def train_bigram(
    tagged: DataFrame, order: list[str], unigram: DataFrame, cutoff: int = 0, default: str = DEFAULT_TAG
) -> DataFrame:
    """Best tag by (previous tag, word), only where the unigram model is wrong somewhere."""
    within = Window.partitionBy(order[0]).orderBy(*order[1:])
    events = tagged.withColumn("previous", F.coalesce(F.lag("tag").over(within), F.lit("")))
    known = unigram.select("word", F.col("tag").alias("backoff"))
    judged = events.join(known, "word", "left").withColumn(
        "backoff", F.coalesce("backoff", F.lit(default))
    )
    wrong = useful(judged, ["previous", "word"], F.col("backoff"))
    return best_tag(events, ["previous", "word"], cutoff).join(wrong, ["previous", "word"], "left_semi")


def tag_words(
    tokens: DataFrame,
    unigram: DataFrame,
    affixes: DataFrame | None = None,
    affix_length: int = -3,
    default: str = DEFAULT_TAG,
) -> DataFrame:
    """Tag by word, then by affix, then the default; one row in, one row out."""
    tagged = tokens.join(unigram.select("word", F.col("tag").alias("_by_word")), "word", "left")
    choices = [F.col("_by_word")]
    if affixes is not None:
        tagged = tagged.withColumn("affix", affix(F.col("word"), affix_length)).join(
            affixes.select("affix", F.col("tag").alias("_by_affix")), "affix", "left"
        )
        choices.append(F.col("_by_affix"))
    tagged = tagged.withColumn("tag", F.coalesce(*choices, F.lit(default)))
    return tagged.select(*tokens.columns, "tag")


def tag_sequences(
    sentences: DataFrame, key: str, bigram: DataFrame, unigram: DataFrame, default: str = DEFAULT_TAG
) -> DataFrame:
    """Tag left to right, each choice feeding the next: (previous tag, word), then word, then default.

    `sentences` has one row per token (key, pos, word).  A word's bigram entries, at most one per
    tag, ride along with the token; the chain then runs inside the row of its sentence.
    """
    by_word = bigram.groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("previous", "tag"))).alias("after")
    )
    known = unigram.select("word", F.col("tag").alias("plain"))
    tokens = sentences.join(by_word, "word", "left").join(known, "word", "left")
    ordered = tokens.groupBy(key).agg(
        F.sort_array(
            F.collect_list(
                F.struct("pos", "word", F.coalesce("plain", F.lit(default)).alias("plain"),
                         F.map_entries("after").alias("after"))
            )
        ).alias("tokens")
    )

    def choose(acc: Column, token: Column) -> Column:
        hit = F.element_at(F.map_from_entries(F.coalesce(token["after"], F.array().cast("array<struct<key:string,value:string>>"))), acc["last"])
        tag = F.coalesce(hit, token["plain"])
        return F.struct(tag.alias("last"), F.concat(acc["tags"], F.array(tag)).alias("tags"))

    start = F.struct(F.lit("").alias("last"), F.array().cast("array<string>").alias("tags"))
    return ordered.select(
        key,
        F.col("tokens.word").alias("words"),
        F.aggregate("tokens", start, choose, lambda acc: acc["tags"]).alias("tags"),
    )


def word_class(tag: Column) -> Column:
    """a, v or r by the first letter of the tag, otherwise n."""
    return (
        F.when(tag.startswith("J"), "a")
        .when(tag.startswith("V"), "v")
        .when(tag.startswith("R"), "r")
        .otherwise("n")
    )
