"""N-gram language models as count tables and left joins down the back-off chain."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.ngrams import ngrams, padded

START, END, UNKNOWN = "<s>", "</s>", "<UNK>"


def words_of(n: int) -> list[str]:
    return [f"w{j}" for j in range(1, n + 1)]


@dataclass
class Counts:
    """Per order m: `grams[m]` (w1 … wm, c), `contexts[m]` (w1 … wm-1, n, t), plus the vocabulary."""

    order: int
    grams: dict[int, DataFrame]
    contexts: dict[int, DataFrame]
    vocabulary: DataFrame

    def vocabulary_size(self) -> Column:
        """Known words and the unknown mark."""
        return self.vocabulary.agg(F.count("*") + 1).scalar()


def vocabulary(texts: DataFrame, tokens: Column, order: int, cutoff: int = 1) -> DataFrame:
    """Words, end marks included, that occur at least `cutoff` times."""
    marked = texts.select(F.explode(padded(tokens, order, START, END)).alias("word"))
    return marked.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= cutoff).select("word")


def masked(grams: DataFrame, vocabulary: DataFrame, n: int) -> DataFrame:
    """Words outside the vocabulary become the unknown mark."""
    for w in words_of(n):
        known = vocabulary.select(F.col("word").alias("_known"))
        grams = grams.join(known, F.col(w) == F.col("_known"), "left").withColumn(
            w, F.coalesce("_known", F.lit(UNKNOWN))
        ).drop("_known")
    return grams


def _context_table(grams: DataFrame, m: int) -> DataFrame:
    """Occurrences and distinct followers of each context."""
    keys = words_of(m - 1)
    return grams.groupBy(*keys).agg(F.sum("c").alias("n"), F.count("*").alias("t"))


def fit(texts: DataFrame, tokens: Column, order: int, cutoff: int = 1) -> Counts:
    """Count first, mask after: each distinct n-gram meets the vocabulary once."""
    known = vocabulary(texts, tokens, order, cutoff)
    grams, contexts = {}, {}
    marked = texts.select(padded(tokens, order, START, END).alias("_marked"))
    for m in range(1, order + 1):
        cut = ngrams(marked, F.col("_marked"), m)
        raw = cut.groupBy(*words_of(m)).agg(F.count("*").alias("c"))
        if cutoff > 1:
            raw = masked(raw, known, m).groupBy(*words_of(m)).agg(F.sum("c").alias("c"))
        grams[m] = raw
        contexts[m] = _context_table(grams[m], m)
    return Counts(order, grams, contexts, known)


def _suffix(n: int, m: int, context: bool = False) -> list[str]:
    """The columns of an n-gram that hold its last m words, or the context of those."""
    columns = words_of(n)[n - m :]
    return columns[:-1] if context else columns


def _with_counts(rows: DataFrame, counts: Counts, n: int) -> DataFrame:
    """c_m, n_m and t_m of every order m down the chain."""
    for m in range(n, 0, -1):
        places = _suffix(n, m)
        side = counts.grams[m].select(
            *[F.col(a).alias(b) for a, b in zip(words_of(m), places)], F.col("c").alias(f"c_{m}")
        )
        rows = rows.join(side, places, "left").withColumn(f"c_{m}", F.coalesce(f"c_{m}", F.lit(0)))
        if m == 1:
            rows = rows.withColumn("n_1", counts.contexts[1].select("n").scalar())
            continue
        places = _suffix(n, m, context=True)
        side = counts.contexts[m].select(
            *[F.col(a).alias(b) for a, b in zip(words_of(m - 1), places)],
            F.col("n").alias(f"n_{m}"),
            F.col("t").alias(f"t_{m}"),
        )
        rows = rows.join(side, places, "left").withColumns(
            {f"n_{m}": F.coalesce(f"n_{m}", F.lit(0)), f"t_{m}": F.coalesce(f"t_{m}", F.lit(0))}
        )
    return rows


def _with_continuations(rows: DataFrame, counts: Counts, n: int) -> DataFrame:
    """Distinct words before an m-gram (cc_m) and before its context (cn_m), for m < n."""
    for m in range(n - 1, 0, -1):
        longer = counts.grams[m + 1]
        inner = words_of(m + 1)[1:]
        by_gram = longer.groupBy(*inner).agg(F.count("*").alias(f"cc_{m}"))
        places = _suffix(n, m)
        side = by_gram.select(*[F.col(a).alias(b) for a, b in zip(inner, places)], f"cc_{m}")
        rows = rows.join(side, places, "left").withColumn(f"cc_{m}", F.coalesce(f"cc_{m}", F.lit(0)))
        if m == 1:
            rows = rows.withColumn("cn_1", longer.agg(F.count("*")).scalar())
            continue
        by_context = longer.groupBy(*inner[:-1]).agg(F.count("*").alias(f"cn_{m}"))
        places = _suffix(n, m, context=True)
        side = by_context.select(*[F.col(a).alias(b) for a, b in zip(inner, places)], f"cn_{m}")
        rows = rows.join(side, places, "left").withColumn(f"cn_{m}", F.coalesce(f"cn_{m}", F.lit(0)))
    return rows


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def mle(n: int) -> Column:
    return _share(F.col(f"c_{n}"), F.col(f"n_{n}"))


def lidstone(n: int, gamma: float, size: Column) -> Column:
    return (F.col(f"c_{n}") + F.lit(gamma)) / (F.col(f"n_{n}") + size * F.lit(gamma))


def stupid_backoff(n: int, alpha: float = 0.4) -> Column:
    score = mle(1)
    for m in range(2, n + 1):
        score = F.when(F.col(f"c_{m}") > 0, F.col(f"c_{m}") / F.col(f"n_{m}")).otherwise(F.lit(alpha) * score)
    return score


def witten_bell(n: int) -> Column:
    score = mle(1)
    for m in range(2, n + 1):
        c, total, types = F.col(f"c_{m}"), F.col(f"n_{m}"), F.col(f"t_{m}")
        gamma = types / (types + total)
        score = F.when(total > 0, (F.lit(1.0) - gamma) * (c / total) + gamma * score).otherwise(score)
    return score


def absolute_discount(n: int, discount: float = 0.75) -> Column:
    score = mle(1)
    for m in range(2, n + 1):
        c, total, types = F.col(f"c_{m}"), F.col(f"n_{m}"), F.col(f"t_{m}")
        alpha = F.greatest(c - F.lit(discount), F.lit(0.0)) / total
        score = F.when(total > 0, alpha + (F.lit(discount) * types) / total * score).otherwise(score)
    return score


def kneser_ney(n: int, discount: float = 0.1) -> Column:
    score = F.col("cc_1") / F.col("cn_1")
    for m in range(2, n + 1):
        c, total = (F.col(f"c_{m}"), F.col(f"n_{m}")) if m == n else (F.col(f"cc_{m}"), F.col(f"cn_{m}"))
        alpha = F.greatest(c - F.lit(discount), F.lit(0.0)) / total
        gamma = F.lit(discount) * F.col(f"t_{m}") / total
        score = F.when((F.col(f"n_{m}") > 0) & (total > 0), alpha + gamma * score).otherwise(score)
    return score


def score(grams: DataFrame, counts: Counts, gamma: float = 0.2) -> DataFrame:
    """Every model's score of each distinct n-gram (w1 … wn and any other columns)."""
    n = counts.order
    rows = _with_continuations(_with_counts(grams, counts, n), counts, n)
    rows = rows.withColumn("_size", counts.vocabulary_size())
    return rows.select(
        *grams.columns,
        mle(n).alias("mle"),
        lidstone(n, gamma, F.col("_size")).alias("lidstone"),
        lidstone(n, 1.0, F.col("_size")).alias("laplace"),
        stupid_backoff(n).alias("stupid_backoff"),
        witten_bell(n).alias("witten_bell"),
        absolute_discount(n).alias("absolute_discount"),
        kneser_ney(n).alias("kneser_ney"),
    )


def perplexity(scored: DataFrame, models: list[str], weight: str = "n") -> DataFrame:
    """Cross-entropy in bits and perplexity of each model over n-grams with their counts."""
    n = F.col(weight)
    bits = [
        F.struct(
            F.lit(m).alias("model"), (-F.log2(F.col(m)) * n).cast("decimal(28,10)").alias("bits"), n.alias("n")
        )
        for m in models
    ]
    sums = scored.select(F.inline(F.array(*bits))).groupBy("model").agg(
        (F.sum("bits").cast("double") / F.sum("n")).alias("entropy")
    )
    return sums.withColumn("perplexity", F.pow(F.lit(2.0), "entropy"))


def trigram_discount(asked: DataFrame, trigrams: DataFrame, discount: float = 0.75) -> DataFrame:
    """Kneser-Ney probability of each asked trigram (w1, w2, w3) from a table of trigram counts.

    A seen trigram loses the discount; an unseen one shares what its bigram saved, by how many
    words stand before (w2, w3); otherwise it is 0.
    """
    pairs = trigrams.groupBy("w1", "w2").agg(F.sum("c").alias("n_pair"), F.count("*").alias("after"))
    before = trigrams.groupBy("w2", "w3").agg(F.count("*").alias("before"))
    holding = trigrams.groupBy("w2").agg(F.count("*").alias("holding"))
    rows = (
        asked.join(trigrams, ["w1", "w2", "w3"], "left")
        .join(pairs, ["w1", "w2"], "left")
        .join(before, ["w2", "w3"], "left")
        .join(holding, "w2", "left")
    )
    left_over = F.col("after") * F.lit(discount) / F.col("n_pair")
    others = F.col("holding") - F.col("after")
    shared = F.when(others > 0, left_over * (F.col("before") / others))
    p = (
        F.when(F.col("c").isNotNull(), (F.col("c") - F.lit(discount)) / F.col("n_pair"))
        .when(F.col("n_pair").isNotNull() & F.col("before").isNotNull(), shared)
        .otherwise(0.0)
    )
    return rows.select(*asked.columns, p.alias("p"))
