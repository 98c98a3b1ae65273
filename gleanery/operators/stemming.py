"""Suffix stripping in the manner of Porter (1980), as successive columns over distinct words."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Runs of consonants and of vowels; y is a vowel after a consonant, an initial y is written Y.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
SOME = f"^({_C})?{_V}{_C}"
ONE = f"^({_C})?{_V}{_C}({_V})?$"
MANY = f"^({_C})?{_V}{_C}{_V}{_C}"
VOWEL = f"^({_C})?[aeiouy]"
# Consonant, vowel, consonant other than w, x, y at the end; or a vowel and a consonant in all.
SHORT = "([^aeiouy][aeiouy]|[aeiou]y[aeiou])[^aeiouwxyY]$|^[aeiou][^aeiou]$"

# Fixed values: (suffix, replacement) in the order in which they are tried.
PLURAL = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DOUBLE = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
DERIVED = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
LAST = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]

def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _first_match(word: Column, rules: list[tuple[str, str]], condition: str | None) -> Column:
    """Apply the first rule whose suffix fits, if what is left meets the condition."""
    chain = None
    for suffix, new in rules:
        rest = _cut(word, len(suffix))
        changed = F.concat(rest, F.lit(new))
        if condition:
            changed = F.when(rest.rlike(condition), changed).otherwise(word)
        fits = word.endswith(suffix)
        chain = F.when(fits, changed) if chain is None else chain.when(fits, changed)
    return chain.otherwise(word)


def _steps() -> list[Column]:
    w = F.col("stem")
    n = F.length(w)
    rest1 = F.when(w.endswith("ed"), _cut(w, 2)).when(w.endswith("ing"), _cut(w, 3))
    # Step 1b leaves the cut word behind a mark, for the repairs of the next step.
    past = (
        F.when(w.endswith("ied"), F.when(n == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
        .when(w.endswith("eed"), F.when(_cut(w, 3).rlike(SOME), _cut(w, 1)).otherwise(w))
        .when(rest1.rlike(VOWEL), F.concat(F.lit("+"), rest1))
        .otherwise(w)
    )
    bare = F.expr("substring(stem, 2)")
    last = F.expr("right(stem, 1)")
    twin = (last == F.substring(w, F.length(w) - 1, F.lit(1))) & ~last.rlike("[aeiou]") & (n > 2)
    repaired = (
        F.when(~w.startswith("+"), w)
        .when(bare.rlike("(at|bl|iz)$"), F.concat(bare, F.lit("e")))
        .when(twin, F.when(last.isin("l", "s", "z"), bare).otherwise(_cut(bare, 1)))
        .when(bare.rlike(ONE) & bare.rlike(SHORT), F.concat(bare, F.lit("e")))
        .otherwise(bare)
    )
    # The y counts as a consonant only after a vowel.
    before = _cut(w, 1)
    consonant_end = before.rlike("[^aeiouy]$") | before.rlike("[aeiou]y$")
    final_y = F.when(w.endswith("y") & (n > 2) & consonant_end, F.concat(before, F.lit("i"))).otherwise(w)
    alli = F.when(w.endswith("alli") & _cut(w, 4).rlike(SOME), _cut(w, 2)).otherwise(w)
    log = F.when(w.endswith("logi"), F.when(_cut(w, 3).rlike(SOME), _cut(w, 1)).otherwise(w)).otherwise(
        _first_match(w, DOUBLE, SOME)
    )
    ending = None
    for suffix in LAST:
        rest = _cut(w, len(suffix))
        allowed = rest.rlike(MANY)
        if suffix == "ion":
            allowed = allowed & rest.rlike("[st]$")
        fits = w.endswith(suffix)
        value = F.when(allowed, rest).otherwise(w)
        ending = F.when(fits, value) if ending is None else ending.when(fits, value)
    final_e = F.when(
        w.endswith("e") & (before.rlike(MANY) | (before.rlike(ONE) & ~before.rlike(SHORT))), before
    ).otherwise(w)
    final_l = F.when(w.endswith("ll") & before.rlike(MANY), before).otherwise(w)
    plural = F.when(w.endswith("ies") & (n == 4), _cut(w, 1)).otherwise(_first_match(w, PLURAL, None))
    return [
        plural, past, repaired, final_y, alli, log, _first_match(w, DERIVED, SOME),
        ending.otherwise(w), final_e, final_l,
    ]


def porter_stems(words: DataFrame, column: str = "word") -> DataFrame:
    """Add `stem`; meant for a table of distinct words, to be joined back."""
    lowered = F.lower(column)
    marked = F.regexp_replace(lowered, "^y", "Y")
    rows = words.withColumn("stem", marked)
    for step in _steps():
        rows = rows.withColumn("stem", F.when(F.length("stem") > 0, step).otherwise(F.col("stem")))
    own = F.lit(None).cast("string")
    for word, stem in IRREGULAR.items():
        own = F.when(lowered == word, stem).otherwise(own)
    kept = F.when(F.length(column) <= 2, lowered)
    return rows.withColumn("stem", F.coalesce(own, kept, F.lower("stem")))
