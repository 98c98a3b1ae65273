"""Agreement between annotators, rank correlation, and set scores."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.tables import ensure_checkpoint_dir


def wide(annotations: DataFrame, coders: list[str]) -> DataFrame:
    """One row per item, one column per coder.  No coder is joined with another."""
    return annotations.groupBy("item").pivot("coder", coders).agg(F.first("label"))


def pairwise(annotations: DataFrame, coders: list[str], distance=None) -> DataFrame:
    """Observed agreement, expected agreement by the coders' own label shares, kappa and
    weighted kappa of every pair of coders.

    `distance(a, b)` is a column expression between 0 and 1; by default labels either agree or not.
    """
    distance = distance or (lambda a, b: F.when(a == b, 0.0).otherwise(1.0))
    table = wide(annotations, coders)
    pairs = list(combinations(coders, 2))
    both = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("la"), F.col(b).alias("lb"))
            for a, b in pairs
        ]
    )
    # Reduced to one row per pair and pair of labels before anything else.
    cells = table.select(F.inline(both)).groupBy("a", "b", "la", "lb").agg(F.count("*").alias("n"))
    observed = cells.groupBy("a", "b").agg(
        F.sum(F.when(F.col("la") == F.col("lb"), F.col("n")).otherwise(0)).alias("n_agree"),
        F.sum(F.when(F.col("la").isNotNull() & F.col("lb").isNotNull(), distance(F.col("la"), F.col("lb")) * F.col("n"))).alias("d_sum"),
    )
    n_items = annotations.select("item").distinct().agg(F.count("*")).scalar()
    shares = annotations.groupBy("coder", "label").agg(F.count("*").alias("n"))
    left = shares.select(F.col("coder").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"))
    right = shares.select(F.col("coder").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"))
    # A few rows: coders times labels.
    expected = (
        observed.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .groupBy("a", "b")
        .agg(
            F.sum(F.when(F.col("la") == F.col("lb"), F.col("na").cast("double") * F.col("nb")).otherwise(0.0)).alias("same"),
            F.sum(distance(F.col("la"), F.col("lb")) * F.col("na").cast("double") * F.col("nb")).alias("apart"),
        )
    )
    ready = observed.join(expected, ["a", "b"]).withColumn("items", n_items.cast("double"))
    items = F.col("items")
    ao, ae = F.col("n_agree") / items, F.col("same") / (items * items)
    weighted = 1 - (F.col("d_sum") / items) / (F.col("apart") / (items * items))
    return ready.select(
        F.col("a").alias("coder_a"),
        F.col("b").alias("coder_b"),
        ao.alias("ao"),
        ae.alias("ae"),
        ((ao - ae) / (1 - ae)).alias("kappa"),
        weighted.alias("weighted_kappa"),
    )


def coefficients(annotations: DataFrame, coders: list[str]) -> DataFrame:
    """Average agreement, S, pi, kappa, multi-kappa, weighted kappa and alpha as one row."""
    pairs = pairwise(annotations, coders).agg(
        F.avg("ao").alias("avg_ao"),
        F.avg("ae").alias("avg_ae"),
        F.avg("kappa").alias("kappa"),
        F.avg("weighted_kappa").alias("weighted_kappa"),
    )
    labels = annotations.groupBy("label").agg(F.count("*").alias("n"))
    overall = labels.agg(
        F.count("*").alias("k"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")
    )
    n_items = annotations.select("item").distinct().agg(F.count("*")).scalar()
    # Disagreement within items with two labels or more, and over all of those labels together.
    cells = annotations.groupBy("item", "label").agg(F.count("*").alias("n"))
    by_item = cells.groupBy("item").agg(
        F.sum("n").alias("m"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")
    ).where("m > 1")
    within = by_item.agg(
        F.sum(((F.col("m").cast("double") * F.col("m") - F.col("squares")) / (F.col("m") - 1)).cast("decimal(28,12)")).alias("d"),
        F.sum("m").alias("m"),
    )
    valid = cells.join(by_item.select("item"), "item", "left_semi").groupBy("label").agg(F.sum("n").alias("n"))
    among = valid.agg(
        F.sum("n").alias("m"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"), F.count("*").alias("k")
    )
    one = pairs.withColumns(
        {
            "o": overall.select(F.struct("*")).scalar(),
            "w": within.select(F.struct("*")).scalar(),
            "g": among.select(F.struct("*")).scalar(),
            "items": n_items.cast("double"),
        }
    )
    chance = F.lit(1.0) / F.col("o.k")
    slots = F.col("items") * len(coders)
    pi_chance = F.col("o.squares") / (slots * slots)
    d_o = F.col("w.d").cast("double") / F.col("w.m")
    m = F.col("g.m").cast("double")
    d_e = (m * m - F.col("g.squares")) / (m * (m - 1))
    ao = F.col("avg_ao")
    return one.select(
        "avg_ao",
        ((ao - chance) / (1 - chance)).alias("s"),
        ((ao - pi_chance) / (1 - pi_chance)).alias("pi"),
        "kappa",
        ((ao - F.col("avg_ae")) / (1 - F.col("avg_ae"))).alias("multi_kappa"),
        "weighted_kappa",
        F.when(F.col("g.k") == 1, 1.0).otherwise(1 - d_o / d_e).alias("alpha"),
    )


def ranks(scores: DataFrame, key: str, score: str) -> DataFrame:
    """Rank by falling score from 0, equal scores sharing the first rank; a null score has no rank.

    Scores of any type are counted first, so that ties are one row; the distinct ones are sorted in parts, and a rank is the
    rows of the parts before plus those before in its part. Only the parts' sizes meet in one task.
    """
    ensure_checkpoint_dir(scores.sparkSession)
    counted = scores.groupBy(score).agg(F.count("*").alias("_n")).where(F.col(score).isNotNull())
    parts = counted.repartitionByRange(F.desc(score)).withColumn("_part", F.spark_partition_id()).checkpoint()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.sum("_n").alias("_size")).select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    before = Window.partitionBy("_part").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_n").over(before), F.lit(0))
    by_score = parts.withColumn("_inside", inside).join(starts, "_part").select(score, (F.col("_start") + F.col("_inside")).alias("rank"))
    return scores.join(by_score, score).select(key, "rank")


def spearman(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """1 - 6 sum d^2 / (n (n^2 - 1)) over the keys that both rank; 0 when there is only one."""
    gap = (F.col("r1") - F.col("r2")).cast("double")
    both = first.select(key, F.col("rank").alias("r1")).join(
        second.select(key, F.col("rank").alias("r2")), key
    )
    sums = both.agg(
        F.sum((gap * gap).cast("decimal(38,0)")).cast("double").alias("d"), F.count("*").cast("double").alias("n")
    )
    n = F.col("n")
    return sums.select(
        F.when(n > 1, 1 - 6 * F.col("d") / (n * (n * n - 1))).otherwise(0.0).alias("rho")
    )


def set_scores(rows: DataFrame, reference: Column, test: Column, alpha: float = 0.5) -> DataFrame:
    """Precision, recall, F and accuracy of a set of rows against a reference set."""
    one = rows.agg(
        F.count_if(reference).alias("n_ref"),
        F.count_if(test).alias("n_test"),
        F.count_if(reference & test).alias("n_both"),
        F.count_if(reference == test).alias("n_same"),
        F.count("*").alias("n"),
    )
    p, r = F.col("n_both") / F.col("n_test"), F.col("n_both") / F.col("n_ref")
    f = F.when(F.col("n_both") > 0, 1 / (F.lit(alpha) / p + F.lit(1 - alpha) / r)).otherwise(0.0)
    return one.select(
        p.alias("precision"), r.alias("recall"), f.alias("f"), (F.col("n_same") / F.col("n")).alias("accuracy")
    )
