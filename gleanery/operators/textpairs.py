"""Corpus scores of hypotheses against references: BLEU, GLEU, chrF, NIST.

Hypotheses have (pair, tokens), references (pair, ref, tokens); a pair may have several
references.  The texts of a pair meet in one row, where their n-grams are matched; for NIST, what
the references hold is counted from windows that are shuffled once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.gram_matches import SEPARATOR, match_counts, matched_grams
from gleanery.operators.ngrams import side_by_side

# Windows of words a task counts together, by expectation.
PLACES = 400_000
# Windows meet by their first words.
HEAD = 3
TINY = 2.2250738585072014e-308


def bleu(refs: DataFrame, hyps: DataFrame, max_n: int = 4) -> DataFrame:
    """Corpus BLEU with uniform weights: matches and totals are summed before they are divided."""
    matched = match_counts(hyps, refs, 1, max_n, best=True).groupBy("n").agg(F.sum("hit").alias("hit"))

    orders = F.array(*[F.lit(n) for n in range(1, max_n + 1)])
    sizes = hyps.select("pair", F.size("tokens").alias("length"), F.explode(orders).alias("n"))
    # A hypothesis shorter than the order still counts one.
    totals = sizes.groupBy("n").agg(
        F.sum(F.greatest(F.col("length") - F.col("n") + 1, F.lit(1))).alias("total")
    )
    hyp_lengths = hyps.select("pair", F.size("tokens").alias("h"))
    ref_lengths = refs.select("pair", F.size("tokens").alias("r"))
    closest = (
        ref_lengths.join(hyp_lengths, "pair")
        .groupBy("pair", "h")
        .agg(F.min(F.struct(F.abs(F.col("r") - F.col("h")).alias("gap"), "r")).alias("best"))
        .agg(F.sum("h").alias("hyp_length"), F.sum("best.r").alias("ref_length"))
    )
    # An order without any match counts as the smallest normal double.
    shared = F.when(F.col("hit") > 0, F.col("hit") / F.col("total")).otherwise(F.lit(TINY))
    precision = (
        totals.join(matched, "n", "left")
        .select("n", F.coalesce("hit", F.lit(0)).alias("hit"), "total")
        .agg(
            F.sum(F.when(F.col("n") == 1, F.col("hit"))).alias("unigrams"),
            (F.sum(F.log(shared)) / max_n).alias("mean_log"),
        )
    )
    h, r = F.col("hyp_length"), F.col("ref_length")
    penalty = F.when(h > r, 1.0).when(h == 0, 0.0).otherwise(F.exp(1 - r / h))
    one = precision.withColumns(
        {
            "hyp_length": closest.select("hyp_length").scalar(),
            "ref_length": closest.select("ref_length").scalar(),
        }
    )
    return one.select(
        F.when(F.col("unigrams") > 0, penalty * F.exp("mean_log")).otherwise(0.0).alias("bleu")
    )


def gleu(refs: DataFrame, hyps: DataFrame, min_n: int = 1, max_n: int = 4) -> DataFrame:
    """Matches over the longer side's n-grams, best reference per pair, summed over the corpus."""

    def n_grams(length: Column) -> Column:
        parts = [F.greatest(length - n + 1, F.lit(0)) for n in range(min_n, max_n + 1)]
        return sum(parts[1:], parts[0])

    hits = match_counts(hyps, refs, min_n, max_n).groupBy("pair", "ref").agg(F.sum("hit").alias("hit"))
    both = (
        refs.select("pair", "ref", n_grams(F.size("tokens")).alias("n_ref"))
        .join(hyps.select("pair", n_grams(F.size("tokens")).alias("n_hyp")), "pair")
        .join(hits, ["pair", "ref"], "left")
        .select("pair", F.coalesce("hit", F.lit(0)).alias("hit"), F.greatest("n_ref", "n_hyp").alias("n_all"))
        .where("n_all > 0")
    )
    share = F.col("hit") / F.col("n_all")
    best = both.groupBy("pair").agg(
        F.max(F.struct(share.alias("share"), -F.col("n_all"), "hit", "n_all")).alias("b")
    )
    return best.agg(
        F.coalesce(F.sum("b.hit") / F.sum("b.n_all"), F.lit(0.0)).alias("gleu")
    )


def chrf(pairs: DataFrame, min_n: int = 1, max_n: int = 6, beta: float = 3.0, epsilon: float = 1e-16) -> DataFrame:
    """Mean character n-gram F over orders and pairs; `pairs` has (pair, reference, hypothesis)."""

    def side(column: str) -> DataFrame:
        letters = F.filter(
            F.split(F.regexp_replace(column, r"(?U)\s+", ""), ""), lambda c: c != ""
        )
        return pairs.select("pair", letters.alias("tokens"))

    refs, hyps = side("reference"), side("hypothesis")
    hits = match_counts(hyps, refs.withColumn("ref", F.lit(0)), min_n, max_n).select("pair", "n", F.col("hit").alias("tp"))
    orders = F.array(*[F.lit(n) for n in range(min_n, max_n + 1)])
    sizes = (
        refs.select("pair", F.size("tokens").alias("r"))
        .join(hyps.select("pair", F.size("tokens").alias("h")), "pair")
        .select("pair", "r", "h", F.explode(orders).alias("n"))
    )
    per = sizes.join(hits, ["pair", "n"], "left").select(
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.greatest(F.col("h") - F.col("n") + 1, F.lit(0)).alias("tpfp"),
        F.greatest(F.col("r") - F.col("n") + 1, F.lit(0)).alias("tpfn"),
    )
    p, r = F.col("tp") / F.col("tpfp"), F.col("tp") / F.col("tpfn")
    factor = F.lit(beta * beta)
    defined = (F.col("tpfp") > 0) & (F.col("tpfn") > 0) & (F.col("tp") > 0)
    f = F.when(defined, (1 + factor) * (p * r) / (factor * p + r)).otherwise(F.lit(epsilon))
    return per.agg((F.sum(f.cast("decimal(28,18)")).cast("double") / F.count("*")).alias("chrf"))


def _first(gram: str, n: int) -> Column:
    return F.substring_index(gram, SEPARATOR, n)


def _frequency(refs: DataFrame, wanted: DataFrame, n_words: int, max_n: int) -> DataFrame:
    """n, gram, f: how often the references hold each wanted gram, and all grams of fewer than `HEAD` words.

    Each place gives one window of up to `max_n` words, which holds its grams of all orders. Windows meet the wanted grams that
    begin as they do, in as many parts as there are words for, and only what is wanted leaves its part.
    """
    rows = refs.select(F.col("tokens").alias("_t"))
    spots = rows.select(F.inline(side_by_side(F.greatest(F.size("_t"), F.lit(0)), tuple(range(max_n)))))
    words = F.concat_ws(SEPARATOR, *[f"w{j + 1}" for j in range(max_n)])
    size = sum([F.col(f"w{j + 1}").isNotNull().cast("int") for j in range(max_n)], F.lit(0))
    windows = spots.select(words.alias("gram"), size.alias("n"), F.lit(False).alias("wanted"))
    asked = wanted.where(F.col("n") >= HEAD).select("gram", "n", F.lit(True).alias("wanted"))
    parts = max(1, -(-(n_words or 0) // PLACES))
    met = windows.unionByName(asked).withColumn("head", _first("gram", HEAD)).repartition(parts, "head")

    def held(orders: list[int]) -> Column:
        grams = [F.struct(F.lit(k).alias("n"), F.when(F.col("n") >= k, _first("gram", k)).alias("gram")) for k in orders]
        return F.array(*grams)

    short = (
        met.where("NOT wanted")
        .select(F.inline(held(list(range(1, min(HEAD, max_n + 1))))))
        .where("gram IS NOT NULL")
        .groupBy("n", "gram")
        .agg(F.count("*").alias("f"))
    )
    if max_n < HEAD:
        return short
    whole = F.array(F.struct("n", "gram"))
    grams = met.select("head", "wanted", F.inline(F.when(F.col("wanted"), whole).otherwise(held(list(range(HEAD, max_n + 1))))))
    long = (
        grams.where("gram IS NOT NULL")
        .groupBy("head", "n", "gram")
        .agg(F.count(F.when(~F.col("wanted"), 1)).alias("f"), F.bool_or("wanted").alias("wanted"))
        .where("wanted AND f > 0")
    )
    return short.unionByName(long.select("n", "gram", "f"))


def nist(refs: DataFrame, hyps: DataFrame, max_n: int = 5) -> DataFrame:
    """Matches weighted by how informative they are in the references."""
    hits = matched_grams(hyps, refs, 1, max_n)
    n_words = refs.agg(F.sum(F.size("tokens"))).first()[0]
    prefix = F.when(F.col("n") > 1, F.regexp_replace("gram", f"{SEPARATOR}[^{SEPARATOR}]*$", ""))
    grams = hits.select("n", "gram").distinct()
    wanted = grams.unionByName(grams.where("n > 1").select((F.col("n") - 1).alias("n"), prefix.alias("gram"))).distinct()
    frequency = _frequency(refs, wanted, n_words, max_n)
    shorter = frequency.select((F.col("n") + 1).alias("n"), F.col("gram").alias("prefix"), F.col("f").alias("f_prefix"))
    info = (
        grams.join(frequency, ["n", "gram"])
        .withColumn("prefix", prefix)
        .join(shorter, ["n", "prefix"], "left")
        .select("n", "gram", F.log2(F.coalesce("f_prefix", F.lit(n_words)) / F.col("f")).alias("info"))
    )
    hit = hits.join(info, ["n", "gram"])
    per_ref = hit.groupBy("pair", "ref", "n").agg(
        F.sum((F.col("info") * F.col("hit")).cast("decimal(28,10)")).alias("num")
    )
    orders = F.array(*[F.lit(n) for n in range(1, max_n + 1)])
    grid = refs.select("pair", "ref", F.size("tokens").alias("r"), F.explode(orders).alias("n")).join(
        hyps.select("pair", F.size("tokens").alias("h")), "pair"
    )
    den = F.greatest(F.col("h") - F.col("n") + 1, F.lit(0))
    num = F.coalesce("num", F.lit(0).cast("decimal(28,10)"))
    scored = grid.join(per_ref, ["pair", "ref", "n"], "left").select(
        "pair", "n", "r", "h", num.alias("num"), den.alias("den"),
        F.when(den > 0, num.cast("double") / den).otherwise(0.0).alias("precision"),
    )
    best = scored.groupBy("pair", "n", "h").agg(
        F.max(F.struct("precision", "num", "den", "r")).alias("b")
    )
    by_order = best.groupBy("n").agg(
        (F.sum("b.num").cast("double") / F.sum("b.den")).alias("precision"),
        F.sum("b.r").alias("r"),
        F.sum("h").alias("h"),
    )
    total = by_order.agg(F.sum("precision").alias("s"), F.sum("r").alias("r"), F.sum("h").alias("h"))
    ratio = F.col("h") / F.col("r")
    # Half the score is lost when the hypotheses are two thirds as long as the references.
    scale = F.lit(0.5).cast("double")
    beta = F.log(scale) / (F.log(F.lit(1.5)) * F.log(F.lit(1.5)))
    penalty = F.when((ratio > 0) & (ratio < 1), F.exp(beta * F.log(ratio) * F.log(ratio))).otherwise(
        F.greatest(F.least(ratio, F.lit(1.0)), F.lit(0.0))
    )
    return total.select((F.col("s") * penalty).alias("nist"))
