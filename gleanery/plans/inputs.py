"""Inputs and SQL fragments that a query and its reference SQL share."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# A small stop list over the words of the four test languages.
STOP_WORDS = (
    "the of and to in is that it for was on with be as by this are at from "
    "de la le les des et un une que en el los der die und den von das"
).split()


def small_frame(spark: SparkSession, **columns: list) -> DataFrame:
    """A local relation: its exact size is in the plan, so Catalyst knows whether to broadcast it."""
    return spark.createDataFrame(pa.table(columns))


def words_frame(spark: SparkSession, words: list[str]) -> DataFrame:
    return small_frame(spark, word=words)


def stop_words(spark: SparkSession) -> DataFrame:
    return words_frame(spark, STOP_WORDS)


def sql_list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


REVIEWS_CTE = """reviews AS (
  SELECT doc_id, source AS category, text AS reviewText,
         split_part(text, chr(10), 1) AS summary,
         'u' || CAST(doc_id % 37 AS VARCHAR) AS reviewerID,
         CAST(1 + doc_id % 5 AS DOUBLE) AS overall,
         printf('devset-%06d', doc_id) AS sourceId
  FROM documents)"""

# The same delimiter classes in RE2 spelling.
SQL_UNICODE = r"""[\x1c-\x1f\x0b\x85\s\p{Z}\p{Nd}()\[\]{}.!?,;:+=\-_"''`~#@&*%€$§\\/]+"""
SQL_BLANK_TAB = r"""[ \t\p{Nd}()\[\]{}.!?,;:+=\-_''"`~#@&%€$§\\/]+"""
SQL_ASCII = r"""[\x0b\s\d()\[\]{}.!?,;:+=\-_"''`~#@&*%€$§\\/]+"""


def sql_tokens(text: str, pattern: str = SQL_UNICODE, min_length: int = 2) -> str:
    return (
        f"list_filter(string_split_regex(lower({text}), '{pattern}'), "
        f"lambda t: length(t) >= {min_length})"
    )


# Bad-word patterns over the test corpus, and their plurals for the SQL side.
BAD_WORDS = ["rewh", "orre", "hehely", "thatin", "que+l", "inoran"]
BAD_PLURALS = ["rewhs", "orres", "hehelies", "thatins", "que+ls", "inorans"]

# A valence lexicon over the test corpus.
VALENCE = {
    "ing": 1.4, "tion": 1.9, "ed": -1.1, "st": -2.2, "ha": 0.9, "thatin": 2.7, "orre": -1.8,
    "rewh": -2.9, "que": 0.6, "er": -0.4, "it": 1.1, "auf": -0.7, "ment": 1.3, "ch": -1.6,
}
# Corpus words that play the part of the modifiers.
EXTRA_NEGATIONS = ["re", "un", "est"]
EXTRA_STRENGTHENERS = ["of", "de", "die"]
EXTRA_DAMPENERS = ["an", "der"]
EXTRA_IDIOMS = {"the it": -1.2, "of the it": 1.5, "it is": 2.1, "and the": 0.7}


def bad_words(spark: SparkSession) -> DataFrame:
    return words_frame(spark, BAD_WORDS)


def valence_lexicon(spark: SparkSession) -> DataFrame:
    return small_frame(spark, word=list(VALENCE), measure=list(VALENCE.values()))


def sql_values(pairs: dict[str, float]) -> str:
    return ", ".join(f"('{word}', {value}::DOUBLE)" for word, value in pairs.items())


MERGED_SQL = "coalesce(summary, '') || ' ' || coalesce(reviewText, '')"
# RE2 has no Unicode word boundary; this is the class of characters outside words.
SQL_OUTSIDE = r"[^\p{L}\p{M}\p{Nd}\p{Pc}]"


def sql_profane(text: str) -> str:
    words = "|".join(sorted(BAD_WORDS + BAD_PLURALS))
    return f"regexp_matches({text}, '(?i)(^|{SQL_OUTSIDE})(?:{words})($|{SQL_OUTSIDE})')"
