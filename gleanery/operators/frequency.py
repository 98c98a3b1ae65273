"""Frequency distributions, their own frequencies, and smoothed probabilities."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counted(samples: DataFrame, column: str) -> DataFrame:
    return samples.groupBy(column).agg(F.count("*").alias("n"))


def total(counts: DataFrame) -> Column:
    """Number of outcomes."""
    return counts.agg(F.sum("n")).scalar()


def bins(counts: DataFrame) -> Column:
    """Number of distinct outcomes."""
    return counts.agg(F.count("*")).scalar()


def freq_dist(counts: DataFrame) -> DataFrame:
    """Count and share of every sample."""
    return counts.withColumn("freq", F.col("n") / total(counts))


def most_common(counts: DataFrame, column: str, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def hapaxes(counts: DataFrame) -> DataFrame:
    return counts.where("n = 1")


def count_of_counts(counts: DataFrame) -> DataFrame:
    """How many samples occur r times."""
    return counts.groupBy(F.col("n").alias("r")).agg(F.count("*").alias("n_r"))


def conditional(samples: DataFrame, condition: str, column: str) -> DataFrame:
    """Count per (condition, sample) and its share within the condition."""
    counts = samples.groupBy(condition, column).agg(F.count("*").alias("n"))
    totals = counts.groupBy(condition).agg(F.sum("n").alias("n_condition"))
    return counts.join(totals, condition).withColumn("freq", F.col("n") / F.col("n_condition"))


def tabulated(samples: DataFrame, condition: str, column: str) -> DataFrame:
    """One row per sample and condition, zero where they never meet; samples without a condition take no part."""
    counts = samples.where(F.col(condition).isNotNull()).groupBy(column, condition).agg(F.count("*").alias("n"))
    known = counts.agg(F.collect_set(condition)).scalar()
    by_sample = counts.groupBy(column).agg(F.map_from_entries(F.collect_list(F.struct(condition, "n"))).alias("_n"))
    listed = by_sample.select(column, "_n", F.explode(known).alias(condition))
    return listed.select(column, condition, F.coalesce(F.try_element_at("_n", F.col(condition)), F.lit(0)).alias("n"))


def lidstone(counts: DataFrame, gamma: float, n_bins: Column | None = None) -> Column:
    """(c + gamma) / (N + B gamma); gamma 1 is Laplace, one half expected likelihood."""
    b = bins(counts) if n_bins is None else n_bins
    return (F.col("n") + F.lit(gamma)) / (total(counts) + b * F.lit(gamma))


def witten_bell(counts: DataFrame) -> Column:
    """c / (N + T)"""
    return F.col("n") / (total(counts) + bins(counts))


def witten_bell_unseen(counts: DataFrame, n_bins: int) -> DataFrame:
    """T / (Z (N + T)): the share of each outcome that was never seen."""
    one = counts.agg(F.sum("n").alias("N"), F.count("*").alias("T"))
    z = F.lit(n_bins) - F.col("T")
    return one.select((F.col("T") / (z * (F.col("N") + F.col("T")))).alias("p"))


def good_turing(counts: DataFrame) -> DataFrame:
    """Simple Good-Turing: probability per count r, renormalised so that the unseen keep N_1 / N.

    Works on the table of counts of counts, whose length is the number of distinct counts.
    Returns r, n_r and p; join on the count for the probability of a sample.
    """
    hist = count_of_counts(counts)
    by_r = Window.orderBy("r")
    below = F.coalesce(F.lag("r").over(by_r), F.lit(0))
    above = F.coalesce(F.lead("r").over(by_r), 2 * F.col("r") - below)
    points = hist.select(
        "r",
        "n_r",
        F.lead("r").over(by_r).alias("next_r"),
        F.lead("n_r").over(by_r).alias("next_n"),
        F.log("r").alias("x"),
        F.log(2.0 * F.col("n_r") / (above - below)).alias("y"),
    )
    fit = points.agg(
        F.struct(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"))
    ).scalar()
    n_all = total(counts)
    ready = points.withColumns({"fit": fit, "N": n_all})

    def smooth(r: Column) -> Column:
        return F.exp(F.col("fit.a") + F.col("fit.b") * F.log(r))

    r, next_n, n_r = F.col("r"), F.col("next_n"), F.col("n_r")
    smooth_star = (r + 1) * smooth(r + 1) / smooth(r)
    plain_star = (r + 1) * next_n / n_r
    spread = F.sqrt((r + 1) * (r + 1) * (next_n / (n_r * n_r)) * (1 + next_n / n_r))
    gap = F.col("next_r").isNull() | (F.col("next_r") != r + 1)
    switches = gap | (F.abs(plain_star - smooth_star) <= 1.96 * spread)
    judged = ready.withColumns({"smooth": smooth_star, "plain": plain_star, "switches": switches})
    switch_at = F.min(F.when(F.col("switches"), F.col("r"))).over(Window.partitionBy())
    measured = judged.withColumn("switch_at", switch_at).withColumn(
        "mass", F.when(r < F.col("switch_at"), F.col("plain")).otherwise(F.col("smooth")) / F.col("N")
    )
    whole = Window.partitionBy()
    seen = F.sum(n_r * F.col("mass")).over(whole)
    unseen = F.sum(F.when(r == 1, n_r).otherwise(0)).over(whole) / F.col("N")
    return measured.select("r", "n_r", (F.col("mass") * (1 - unseen) / seen).alias("p"))
