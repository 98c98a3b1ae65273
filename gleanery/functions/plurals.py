"""English plural of a word column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered suffix rules (pattern, replacement); the first match applies.
SUFFIX_RULES = [
    (r"(?i)(quiz)$", r"$1zes"),
    (r"(?i)^(oxen)$", r"$1"),
    (r"(?i)^(ox)$", r"$1en"),
    (r"(?i)(m|l)ice$", r"$1ice"),
    (r"(?i)(m|l)ouse$", r"$1ice"),
    (r"(?i)(passer)s?by$", r"$1sby"),
    (r"(?i)(matr|vert|ind)(?:ix|ex)$", r"$1ices"),
    (r"(?i)(x|ch|ss|sh)$", r"$1es"),
    (r"(?i)([^aeiouy]|qu)y$", r"$1ies"),
    (r"(?i)(hive)$", r"$1s"),
    (r"(?i)([lr])f$", r"$1ves"),
    (r"(?i)([^f])fe$", r"$1ves"),
    (r"(?i)sis$", r"ses"),
    (r"(?i)([ti])a$", r"$1a"),
    (r"(?i)([ti])um$", r"$1a"),
    (r"(?i)(buffal|potat|tomat)o$", r"$1oes"),
    (r"(?i)(bu)s$", r"$1ses"),
    (r"(?i)(alias|status)$", r"$1es"),
    (r"(?i)(octop|vir)i$", r"$1i"),
    (r"(?i)(octop|vir)us$", r"$1i"),
    (r"(?i)^(ax|test)is$", r"$1es"),
    (r"(?i)s$", r"s"),
    (r"$", r"s"),
]
# Irregular words; a later pair wins over an earlier one and over the rules.
IRREGULAR = [
    ("person", "people"),
    ("man", "men"),
    ("human", "humans"),
    ("child", "children"),
    ("sex", "sexes"),
    ("move", "moves"),
    ("cow", "kine"),
    ("zombie", "zombies"),
]
# Words that are their own plural.
UNCOUNTABLE = [
    "equipment", "fish", "information", "jeans", "money", "rice", "series", "sheep", "species",
]


def _irregular_rules() -> list[tuple[str, str]]:
    rules = []
    for singular, plural in reversed(IRREGULAR):
        if singular[0] == plural[0]:
            for form in (plural, singular):
                rules.append((f"(?i)({form[0]}){form[1:]}$", f"$1{plural[1:]}"))
            continue
        # The first letter changes, so its case decides the case of the result.
        for form in (plural, singular):
            for case in (str.lower, str.upper):
                rules.append((f"{case(form[0])}(?i:{form[1:]})$", case(plural[0]) + plural[1:]))
    return rules


PLURAL_RULES = _irregular_rules() + SUFFIX_RULES


def plural(word: Column) -> Column:
    result = F.when((word == "") | F.lower(word).isin(UNCOUNTABLE), word)
    for pattern, replacement in PLURAL_RULES:
        result = result.when(word.rlike(pattern), F.regexp_replace(word, pattern, replacement))
    return result
