"""Distances between words and between sets, as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def binary_distance(a: Column, b: Column) -> Column:
    return F.when(a == b, 0.0).otherwise(1.0)


def _sizes(a: Column, b: Column) -> tuple[Column, Column]:
    return F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))


def jaccard_distance(a: Column, b: Column) -> Column:
    both, either = _sizes(a, b)
    return (either - both) / either


def masi_distance(a: Column, b: Column) -> Column:
    """Jaccard, weighted by whether the sets are equal, nested, overlapping or apart."""
    both, either = _sizes(a, b)
    na, nb = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    weight = (
        F.when((na == nb) & (na == both), 1.0)
        .when(both == F.least(na, nb), 0.67)
        .when(both > 0, 0.33)
        .otherwise(0.0)
    )
    return 1 - both / either * weight


def letters(word: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(word, "")), "")


def _jaro(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    reach = max(len(a), len(b)) // 2 - 1
    taken, matched = set(), []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(i + reach, len(b) - 1) + 1):
            if b[j] == letter and j not in taken:
                taken.add(j)
                matched.append(letter)
                break
    m = len(matched)
    if not m:
        return 0.0
    swapped = sum(c != b[j] for c, j in zip(matched, sorted(taken))) // 2
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def jaro_similarity(a: Column, b: Column) -> Column:
    """Share of letters that match within reach of each other, less the swapped ones; null if a side is."""
    return F.udf(_jaro, "double", useArrow=True)(a, b)


def jaro_winkler_similarity(a: Column, b: Column, p: float = 0.1, max_prefix: int = 4, jaro: Column | None = None) -> Column:
    """Jaro, raised by the length of the common prefix; `jaro` is a column that holds it already, if there is one."""
    prefix = F
    for n in range(max_prefix, 0, -1):
        same = (F.length(a) >= n) & (F.length(b) >= n) & (F.substring(a, 1, n) == F.substring(b, 1, n))
        prefix = prefix.when(same, n)
    prefix = prefix.otherwise(0) if max_prefix > 0 else F.lit(0)
    jaro = jaro_similarity(a, b) if jaro is None else jaro
    return jaro + prefix * F.lit(p) * (1 - jaro)


def costed_edit_distance(
    a: Column, b: Column, substitution_cost: int = 1, transpositions: bool = False
) -> Column:
    """Edit distance with a price for substitutions and, if wanted, swaps of letters; null if a side is.

    The table of distances is a fold: one row of it for each letter of `a`, one cell for each letter of `b`. All rows stay in
    the state, since a swap looks back to the row of the last letter alike; `seen` has that row for each letter of `b`.
    """
    kinds = "struct<rows:array<array<int>>,seen:array<int>>"

    def spelled(text: Column) -> Column:
        return F.array_remove(F.split(text, ""), "")

    def measured(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        first = F.sequence(F.lit(0), F.size(y))
        start = F.struct(F.array(first).alias("rows"), F.transform(y, lambda c: F.lit(0)).alias("seen")).cast(kinds)

        def row(state: Column, letter: Column) -> Column:
            above = F.element_at(state["rows"], -1)
            i = F.size(state["rows"])  # letters of `x` up to here

            def cell(line: Column, place: Column) -> Column:
                j = place["j"]
                same = place["c"] == letter
                best = F.least(
                    F.get(above, j) + 1,
                    F.element_at(line["cells"], -1) + 1,
                    F.get(above, j - 1) + F.when(same, 0).otherwise(substitution_cost),
                )
                if transpositions:
                    back, match = F.get(state["seen"], j - 1), line["match"]
                    swapped = F.get(F.get(state["rows"], back - 1), match - 1) + (i - back - 1) + 1 + (j - match - 1)
                    best = F.when((back > 0) & (match > 0), F.least(best, swapped)).otherwise(best)
                match = F.when(same, j).otherwise(line["match"])
                return F.struct(F.array_append(line["cells"], best).alias("cells"), match.alias("match")).cast("struct<cells:array<int>,match:int>")

            places = F.transform(y, lambda c, j: F.struct(c.alias("c"), (j + 1).alias("j")))
            line = F.struct(F.array(i).alias("cells"), F.lit(0).alias("match")).cast("struct<cells:array<int>,match:int>")
            cells = F.aggregate(places, line, cell, lambda line: line["cells"])
            seen = F.zip_with(y, state["seen"], lambda c, back: F.when(c == letter, i).otherwise(back))
            return F.struct(F.array_append(state["rows"], cells).alias("rows"), seen.alias("seen")).cast(kinds)

        return F.aggregate(x, start, row, lambda state: F.element_at(F.element_at(state["rows"], -1), -1))

    pair = F.struct(spelled(a).alias("x"), spelled(b).alias("y"))
    return F.when(a.isNotNull() & b.isNotNull(), F.transform(F.array(pair), measured)[0].cast("long"))
