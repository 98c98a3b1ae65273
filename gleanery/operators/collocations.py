"""Word pairs, triples and quadruples that occur together, and how strongly."""

from collections import Counter, defaultdict
from collections.abc import Callable
from functools import partial, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.frequent_grams import frequent_grams
from gleanery.operators.ngrams import side_by_side

# Fixed value: keeps logarithms and quotients of empty cells defined.
SMALL = 1e-20


def _counted(texts: DataFrame, tokens: Column, n: int, window: int, *places: str) -> DataFrame:
    """The words at some places of the n-grams, with their count: each position with every choice of n - 1 later ones in the
    window. A text's end cuts grams short, and what is left of them counts as well.

    Each marginal is counted from the texts, over the places it fixes only: so its shuffle has its own few columns and rows,
    where a sum over the counted n-grams would move all of these again for every marginal.
    """
    at = [int(place[1:]) - 1 for place in places]
    shapes = Counter(tuple((0, *later)[j] for j in at) for later in combinations(range(1, window), n - 1))
    rows = texts.select(tokens.alias("_t"))
    # Shapes that agree in these places are one, counted as often.
    by_times = defaultdict(list)
    for shape, times in shapes.items():
        by_times[times].append(shape)
    spots = [
        rows.select(F.inline(F.concat(*[side_by_side(F.size("_t"), s) for s in same]))).withColumn("_times", F.lit(times).cast("long"))
        for times, same in by_times.items()
    ]
    names = [f"w{j + 1}" for j in range(len(places))]
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    found = reduce(DataFrame.unionByName, spots).where(present)
    return found.groupBy(*[F.col(c).alias(p) for c, p in zip(names, places)]).agg(F.sum("_times").alias("n"))


def _lookup(grams: DataFrame, counts: DataFrame, places: tuple[str, ...], name: str) -> DataFrame:
    """Attach the count of the words at the given places."""
    keys = [c for c in counts.columns if c != "n"]
    side = counts.select(*[F.col(k).alias(p) for k, p in zip(keys, places)], F.col("n").alias(name))
    return grams.join(side, list(places), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def _in_order(grams: DataFrame, n: int) -> DataFrame:
    """Words, count and marginals in the order that looking marginals up one by one gives."""
    marginals = sorted([c for c in grams.columns if c.startswith("n_")], key=lambda c: (c.count("x"), c))
    return grams.select(*[f"w{j}" for j in range(n, 0, -1)], marginals[0], F.col(marginals[0]).alias("count"), *marginals[1:])


def bigrams(texts: DataFrame, tokens: Column, window: int = 2) -> DataFrame:
    """w1, w2, count, n_ii (scaled by the window), n_ix, n_xi, n_xx."""
    words = texts.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    pairs = _counted(texts, tokens, 2, window, "w1", "w2").withColumnRenamed("n", "count")
    out = _lookup(pairs, words, ("w1",), "n_ix")
    out = _lookup(out, words, ("w2",), "n_xi")
    n_all = words.agg(F.sum("n")).scalar()
    return out.withColumn("n_ii", F.col("count") / F.lit(window - 1.0)).withColumn("n_xx", n_all)


def trigrams(texts: DataFrame, tokens: Column, window: int = 3, min_count: int | None = None) -> DataFrame:
    """w1 … w3 with all marginals, each named by the places it fixes (i) and leaves open (x).

    With `min_count`, triples found less often are left out, and what is left is counted by numbers in place of words.
    """
    if min_count is not None:
        return _in_order(frequent_grams(texts, tokens, 3, window, min_count), 3)
    count = partial(_counted, texts, tokens, 3, window)
    words, pairs, wild = count("w1"), count("w1", "w2"), count("w1", "w3")
    out = count("w1", "w2", "w3").withColumnRenamed("n", "n_iii")
    out = out.withColumn("count", F.col("n_iii"))
    for places, counts, name in [
        (("w1", "w2"), pairs, "n_iix"), (("w1", "w3"), wild, "n_ixi"), (("w2", "w3"), pairs, "n_xii"),
        (("w1",), words, "n_ixx"), (("w2",), words, "n_xix"), (("w3",), words, "n_xxi"),
    ]:
        out = _lookup(out, counts, places, name)
    return out.withColumn("n_xxx", words.agg(F.sum("n")).scalar())


def quadgrams(texts: DataFrame, tokens: Column, window: int = 4, min_count: int | None = None) -> DataFrame:
    """w1 … w4 with all marginals; `min_count` as for triples."""
    if min_count is not None:
        return _in_order(frequent_grams(texts, tokens, 4, window, min_count), 4)
    count = partial(_counted, texts, tokens, 4, window)
    words = count("w1")
    ii, ixi, ixxi = count("w1", "w2"), count("w1", "w3"), count("w1", "w4")
    iii, iixi, ixii = count("w1", "w2", "w3"), count("w1", "w2", "w4"), count("w1", "w3", "w4")
    out = count("w1", "w2", "w3", "w4").withColumnRenamed("n", "n_iiii")
    out = out.withColumn("count", F.col("n_iiii"))
    for places, counts, name in [
        (("w1", "w2", "w3"), iii, "n_iiix"), (("w1", "w2", "w4"), iixi, "n_iixi"),
        (("w1", "w3", "w4"), ixii, "n_ixii"), (("w2", "w3", "w4"), iii, "n_xiii"),
        (("w1", "w2"), ii, "n_iixx"), (("w1", "w3"), ixi, "n_ixix"), (("w1", "w4"), ixxi, "n_ixxi"),
        (("w2", "w4"), ixi, "n_xixi"), (("w3", "w4"), ii, "n_xxii"), (("w2", "w3"), ii, "n_xiix"),
        (("w1",), words, "n_ixxx"), (("w2",), words, "n_xixx"),
        (("w3",), words, "n_xxix"), (("w4",), words, "n_xxxi"),
    ]:
        out = _lookup(out, counts, places, name)
    return out.withColumn("n_xxxx", words.agg(F.sum("n")).scalar())


def frequent(grams: DataFrame, min_count: int) -> DataFrame:
    return grams.where(F.col("count") >= min_count)


def without_words(grams: DataFrame, n: int, unwanted: Callable[[Column], Column]) -> DataFrame:
    """Drop every gram one of whose words is unwanted."""
    for j in range(1, n + 1):
        grams = grams.where(~unwanted(F.col(f"w{j}")))
    return grams


def ranked(scored: DataFrame, n: int, score: str = "score") -> DataFrame:
    return scored.orderBy(F.desc(score), *[F.asc(f"w{j + 1}") for j in range(n)])


def n_best(scored: DataFrame, n: int, k: int, score: str = "score") -> DataFrame:
    return ranked(scored, n, score).limit(k)


def above(scored: DataFrame, minimum: float, score: str = "score") -> DataFrame:
    return scored.where(F.col(score) > minimum)


class Measures:
    """Association measures over the marginals of an n-gram, as columns."""

    def __init__(self, n: int):
        self.n = n
        self.gram = F.col("n_" + "i" * n).cast("double")
        self.all = F.col("n_" + "x" * n).cast("double")
        self.words = [F.col("n_" + "x" * j + "i" + "x" * (n - j - 1)).cast("double") for j in range(n)]

    def _marginal(self, fixed: frozenset[int]) -> Column:
        return F.col("n_" + "".join("i" if j in fixed else "x" for j in range(self.n))).cast("double")

    def _places(self) -> list[frozenset[int]]:
        """All sets of places, the full set first and the empty one last."""
        sets = [
            frozenset(c) for size in range(self.n, -1, -1) for c in combinations(range(self.n), size)
        ]
        return sets

    def cells(self) -> dict[frozenset[int], Column]:
        """How often exactly these places hold their words, by inclusion and exclusion."""
        out = {}
        for here in self._places():
            terms = [
                self._marginal(more) * F.lit((-1.0) ** (len(more) - len(here)))
                for more in self._places()
                if more >= here
            ]
            out[here] = reduce(lambda a, b: a + b, terms)
        return out

    def expected(self) -> dict[frozenset[int], Column]:
        """Cells under independence: the product of each place's own share."""
        out = {}
        for here in self._places():
            sides = [
                self.words[j] if j in here else self.all - self.words[j] for j in range(self.n)
            ]
            product = reduce(lambda a, b: a * b, sides)
            out[here] = product / reduce(lambda a, b: a * b, [self.all] * (self.n - 1))
        return out

    def _product(self) -> Column:
        return reduce(lambda a, b: a * b, self.words)

    def _all_power(self) -> Column:
        return reduce(lambda a, b: a * b, [self.all] * (self.n - 1))

    def raw_freq(self) -> Column:
        return self.gram / self.all

    def student_t(self) -> Column:
        return (self.gram - self._product() / self._all_power()) / F.sqrt(self.gram + SMALL)

    def chi_sq(self) -> Column:
        cells, expected = self.cells(), self.expected()
        parts = [(cells[k] - expected[k]) * (cells[k] - expected[k]) / (expected[k] + SMALL) for k in cells]
        return reduce(lambda a, b: a + b, parts)

    def mi_like(self, power: int = 3) -> Column:
        return reduce(lambda a, b: a * b, [self.gram] * power) / self._product()

    def pmi(self) -> Column:
        return F.log2(self.gram * self._all_power()) - F.log2(self._product())

    def likelihood_ratio(self) -> Column:
        cells, expected = self.cells(), self.expected()
        parts = [cells[k] * F.log(cells[k] / (expected[k] + SMALL) + SMALL) for k in cells]
        return F.lit(2.0) * reduce(lambda a, b: a + b, parts)

    def poisson_stirling(self) -> Column:
        expected = self._product() / self._all_power()
        return self.gram * (F.log2(self.gram / expected) - 1)

    def jaccard(self) -> Column:
        cells = self.cells()
        some = [v for k, v in cells.items() if k]
        return self.gram / reduce(lambda a, b: a + b, some)


class BigramMeasures(Measures):
    def __init__(self):
        super().__init__(2)

    def phi_sq(self) -> Column:
        c = self.cells()
        ii, io, oi, oo = (c[frozenset(k)] for k in ({0, 1}, {0}, {1}, set()))
        gap = ii * oo - io * oi
        return gap * gap / ((ii + io) * (ii + oi) * (io + oo) * (oi + oo))

    def chi_sq(self) -> Column:
        return self.all * self.phi_sq()

    def dice(self) -> Column:
        return F.lit(2.0) * self.gram / (self.words[0] + self.words[1])
