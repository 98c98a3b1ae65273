"""Column expressions that turn text into arrays of tokens.  All run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter classes that define the term space.
# U+001C-U+001F count as white space here although Java leaves them out.
UNICODE_DELIMITERS = "(?U)[\\x1c-\\x1f\\s\\d()\\[\\]{}.!?,;:+=\\-_\"'`~#@&*%€$§\\\\/]+"
BLANK_TAB_DELIMITERS = "(?U)[ \\t\\d()\\[\\]{}.!?,;:+=\\-_'\"`~#@&%€$§\\\\/]+"
ASCII_DELIMITERS = "[\\s\\d()\\[\\]{}.!?,;:+=\\-_\"'`~#@&*%€$§\\\\/]+"
NON_WORD = "\\W+"

DELIMITERS = {
    "unicode": UNICODE_DELIMITERS,
    "blank_tab": BLANK_TAB_DELIMITERS,
    "ascii": ASCII_DELIMITERS,
    "non_word": NON_WORD,
}


def tokens(text: Column, tokenizer: str = "unicode", min_length: int = 2) -> Column:
    """Lower-cased tokens of at least `min_length` characters, in text order; null text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), DELIMITERS[tokenizer])
    return F.filter(parts, lambda t: F.length(t) >= min_length)


def token_set(text: Column, tokenizer: str = "unicode", min_length: int = 2) -> Column:
    return F.array_distinct(tokens(text, tokenizer, min_length))


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters, whatever surrounds them."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+"), "")


def merged_text(summary: Column, body: Column, null_as: str = "") -> Column:
    """Summary, blank, body.  The blank stays even when a side is missing."""
    return F.concat(
        F.coalesce(summary, F.lit(null_as)), F.lit(" "), F.coalesce(body, F.lit(null_as))
    )
