"""Sentence and word splitting, and the delimiter tokenisers, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A default abbreviation list; a full stop after one of these ends no sentence.
ABBREVIATIONS = "mr mrs ms dr prof st jr sr vs etc inc ltd co corp e.g i.e fig no vol".split()
CLOSERS = "[\"'”’)\\]]*"
BLANKS = "[\\s\\x1c-\\x1f]"


# Stands between sentences while a text is rewritten; white space to no rule but the last split.
MARK = "\x1e"


def _marked(text: Column, abbreviations: list[str]) -> Column:
    """The text with a mark in place of the white space after every sentence."""
    short = "|".join(a.replace(".", "\\.") for a in abbreviations)
    # Each pattern starts with the rare character and looks back from there.
    kept = F.regexp_replace(
        F.trim(F.coalesce(text, F.lit(""))),
        f"\\.(?<=(?:^|[^\\p{{L}}])(?i:{short})\\.)",
        "\x1d",
    )
    cut = F.regexp_replace(kept, f"(?U)([.!?]{CLOSERS}){BLANKS}+", f"$1{MARK}")
    return F.translate(cut, "\x1d", ".")


def sentences(text: Column, abbreviations: list[str] = ABBREVIATIONS) -> Column:
    """Cut after . ! or ? (and closing quotes or brackets) before white space."""
    return F.filter(F.split(_marked(text, abbreviations), MARK), lambda s: s != "")


# Ordered rewrites that put blanks around tokens.  They see all sentences of a
# text at once, so the start and the end of a sentence are a mark or an end of the text.
# Rules that touch different characters share a pass.
OPENING_QUOTES = [
    ("[«“‘„]|`+", " $0 "),
    (f'(^|{MARK})"', "$1``"),
    ("``", " $0 "),
    ("([ (\\[{<])(\"|'{2})", "$1 `` "),
    ("(')(?iU)(?!re|ve|ll|m|t|s|d|n)(\\w)\\b", "$1 $2"),
]
PUNCTUATION = [
    (f"(?U)([^.{MARK}])(\\.)([\\])}}>\"'»”’ ]*)\\s*(?={MARK}|$)", "$1 $2 $3 "),
    (f"([:,])(?U)([^\\d{MARK}]|(?={MARK}|$))", " $1 $2"),
    (f"(?U)([^.{MARK}])(\\.)([\\])}}>\"']*)\\s*(?={MARK}|$)", "$1 $2$3 "),
    (f"'(?<=[^'{MARK}]') ", " ' "),
    ("\\.{2,}|--|[;@#$%&?!*\\]\\[(){}<>»”’]", " $0 "),
]
CLOSING_QUOTES = [
    ("''|\"", " '' "),
    ("(?U)\\s+", " "),
    (f"'(?<=[^' {MARK}]')([sSmMdD]?) ", " '$1 "),
    (f"(?=['nN])(?<=[^' {MARK}])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", " $1 "),
]
CONTRACTIONS = [
    (
        "(?=[cdglmwCDGLMW])(?iU)\\b(?:(can)(not)|(d)('ye)|(gim)(me)|(gon)(na)|(got)(ta)|(lem)(me)"
        "|(more)('n)|(wan)(na)(?=\\s))\\b",
        " $1$3$5$7$9$11$13$15 $2$4$6$8$10$12$14$16 ",
    ),
    (" (?iU)('t)(is|was)\\b", " $1 $2 "),
]
BRACKET_NAMES = [
    ("\\(", "-LRB-"), ("\\)", "-RRB-"), ("\\[", "-LSB-"), ("\\]", "-RSB-"),
    ("\\{", "-LCB-"), ("\\}", "-RCB-"),
]


def _rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def words(
    text: Column, abbreviations: list[str] = ABBREVIATIONS, name_brackets: bool = False
) -> Column:
    """The tokens of a text, sentence by sentence, in order.

    Every rewrite runs once over the whole text rather than once per sentence.
    """
    names = BRACKET_NAMES if name_brackets else []
    marked = _rewrite(
        _marked(text, abbreviations), OPENING_QUOTES + PUNCTUATION + names
    )
    spaced = F.concat(F.lit(" "), F.regexp_replace(marked, MARK, f" {MARK} "), F.lit(" "))
    return F.array_remove(
        F.split(_rewrite(spaced, CLOSING_QUOTES + CONTRACTIONS), f"(?U){BLANKS}+"), ""
    )


def pattern_tokens(text: Column, pattern: str) -> Column:
    """Everything the pattern matches."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def gap_tokens(text: Column, pattern: str) -> Column:
    """Everything between matches of the pattern, without empty pieces."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), pattern), lambda t: t != "")


def word_punct_tokens(text: Column) -> Column:
    return pattern_tokens(text, "(?U)\\w+|[^\\w\\s]+")


def blank_line_tokens(text: Column) -> Column:
    return gap_tokens(text, "\\s*\\n\\s*\\n\\s*")


def white_space_tokens(text: Column) -> Column:
    return gap_tokens(text, f"(?U){BLANKS}+")


def line_tokens(text: Column, blank_lines: str = "discard") -> Column:
    """Lines; blank ones are discarded, kept, or dropped only at the end (`discard-eof`)."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r\n|\r|\n")
    blank = lambda s: F.trim(s) == ""
    if blank_lines == "discard":
        return F.filter(lines, lambda s: ~blank(s))
    last = F.element_at(lines, -1)
    cut = F.when(blank(last), F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    if blank_lines == "discard-eof":
        return cut
    return F.when(last == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def space_tokens(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), " ")


def tab_tokens(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\t")


def merge_expressions(tokens: Column, expressions: list[list[str]], separator: str = "_") -> Column:
    """Join listed multi-word expressions into one token each; the longest wins."""
    quote = lambda t: "\\Q" + t + "\\E"
    joined = F.array_join(tokens, "\x01")
    for parts in sorted(expressions, key=len, reverse=True):
        pattern = "(?<=^|\x01)" + "\x01".join(quote(p) for p in parts) + "(?=\x01|$)"
        joined = F.regexp_replace(joined, pattern, separator.join(parts).replace("$", "\\$"))
    return F.when(F.size(tokens) == 0, tokens).otherwise(F.split(joined, "\x01"))
