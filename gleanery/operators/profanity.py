"""Bad-word lexicons, the profanity test and the censor.

A lexicon is a DataFrame with one regular-expression fragment per row (column `word`).
It reaches the rows as a scalar subquery: one aggregated pattern, compiled once per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.plurals import plural


def define_words(words: DataFrame) -> DataFrame:
    """Use this list instead of any other; blank entries are dropped."""
    return words.select(F.trim("word").alias("word")).where("word <> ''")


def append_words(lexicon: DataFrame, extra: DataFrame) -> DataFrame:
    return lexicon.select("word").unionByName(define_words(extra))


def remove_words(lexicon: DataFrame, gone: DataFrame) -> DataFrame:
    return lexicon.select("word").join(gone.select("word"), "word", "left_anti")


def escaped(lexicon: DataFrame) -> DataFrame:
    """Read the entries as plain words rather than as patterns."""
    return lexicon.select(
        F.regexp_replace("word", r"([\\.\[\]{}()*+?^$|\-])", r"\\$1").alias("word")
    )


def profane_words(lexicon: DataFrame) -> DataFrame:
    """The list in use: every entry and its plural, once, longest first."""
    words = lexicon.select("word")
    return words.unionByName(words.select(plural(F.col("word")).alias("word"))).distinct()


def _bounded(alternatives: Column, boundaries: bool) -> Column:
    edge = r"\b" if boundaries else ""
    return F.concat(F.lit(f"(?iU){edge}(?:"), alternatives, F.lit(f"){edge}"))


def profanity_pattern(lexicon: DataFrame, boundaries: bool = True) -> Column:
    """All entries as one alternation; null when the lexicon is empty."""
    joined = F.array_join(F.sort_array(F.collect_list("word")), "|")
    pattern = F.when(F.count("*") > 0, _bounded(joined, boundaries))
    return profane_words(lexicon).agg(pattern.alias("pattern")).scalar()


def is_profane(text: Column, pattern: Column) -> Column:
    # regexp_instr keeps its compiled pattern from row to row; rlike would not.
    return F.coalesce(F.regexp_instr(text, pattern) > 0, F.lit(False))


def censor_steps(lexicon: DataFrame, mark: str = "*", boundaries: bool = True) -> Column:
    """One (length, pattern, mask) step per word length, longest first."""
    steps = (
        profane_words(lexicon)
        .groupBy(F.length("word").alias("size"))
        .agg(F.array_join(F.sort_array(F.collect_list("word")), "|").alias("words"))
    )
    step = F.struct(
        "size",
        _bounded(F.col("words"), boundaries).alias("pattern"),
        F.repeat(F.lit(mark), F.col("size")).alias("mask"),
    )
    return steps.agg(F.sort_array(F.collect_list(step), asc=False).alias("steps")).scalar()


def censor(
    rows: DataFrame, text: Column, lexicon: DataFrame, mark: str = "*", boundaries: bool = True
) -> DataFrame:
    """Add `censored`: every match masked with as many marks as its pattern has characters.

    Only the texts that match at all walk through the steps.
    """
    ready = rows.withColumns(
        {
            "_text": text,
            "_profane": is_profane(text, profanity_pattern(lexicon, boundaries)),
            "_steps": censor_steps(lexicon, mark, boundaries),
        }
    )
    masked = F.aggregate(
        "_steps", F.col("_text"), lambda acc, s: F.regexp_replace(acc, s["pattern"], s["mask"])
    )
    return ready.withColumn(
        "censored", F.when(F.col("_profane"), masked).otherwise(F.col("_text"))
    ).drop("_text", "_profane", "_steps")
