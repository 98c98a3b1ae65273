"""Stemming of a word column by one pattern."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the usual example pattern.
DEFAULT_PATTERN = "ing$|s$|e$|able$"


def regexp_stem(word: Column, pattern: str = DEFAULT_PATTERN, min_length: int = 0) -> Column:
    """Remove what the pattern matches from words of at least `min_length` letters."""
    return F.when(F.length(word) < min_length, word).otherwise(F.regexp_replace(word, pattern, ""))
