"""Mixing sources to target weights by weighted sampling, in DataFrame operations only.

Sources, ordered by code point with null last, get the given weights in turn and share `share` times the words of all
documents; no target exceeds `max_epochs` times its source, and the excess goes to the others by weight. A source's
target is met by complete epochs first, each of which takes every document once, and then by an Efraimidis-Spirakis
sample: each document gets an exponential key divided by its quality weight, the keys are sorted within the source,
and documents are taken while the prefix sum of their words fits what is left. One more document, the one whose size
is nearest to the gap that remains, closes it where that brings the sum nearer to the target.

Keys come from a hash of the id, so reruns agree. Sizes count words; a null text has none. A null source is a source.
Rows that repeat an id share its key and are sampled one by one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.frames import WORD_CHARACTER, ranged

WEIGHTS = [5, 2, 1]
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CHARACTER + "+")), F.lit(0)).cast("long")


def sample_key(key: str, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight, with u in (0, 1) from a hash of the id: the smaller, the earlier taken."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)
    return -F.log(u) / weight


def quality_weight(quality: Column) -> Column:
    """Twice the weight for documents labelled good, half of it for those labelled bad."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def targets(
    sizes: DataFrame, weights: list[int] = WEIGHTS, share: float = 1.5, max_epochs: int = 2
) -> DataFrame:
    """Per source (source, source_size): its target. One row a source, so one task orders them.

    Ordered by the level at which a source reaches its cap, those before the first that stays below are capped; the
    rest share what is left by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", turn).withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = share * F.sum("source_size").over(everything)
    leveled = weighed.withColumns({"place": F.row_number().over(by_level), "level": (total - before) / after})
    open_at = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))).over(everything)
    return leveled.withColumn("open", open_at).select(
        "source",
        "source_size",
        F.when(F.col("place") >= F.col("open.place"), F.col("open.level") * F.col("weight"))
        .otherwise(F.col("cap"))
        .alias("target"),
    )


def mixed(sized: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Add source_size, target, copies and taken to rows of (key, source, size, sample_key).

    Prefix sums run in sorted parts of all rows and start from the sums of the parts before, so a source of any size
    is spread over many tasks.
    """
    order = ["source", "sample_key", key, "size"]
    parts = ranged(sized, *order)
    sizes = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = parts.groupBy("source", "_part").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    budgets = (
        targets(sizes, **options)
        .withColumn("epochs", epochs)
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    plan = starts.alias("s").join(budgets.alias("b"), F.expr("s.source <=> b.source")).select("s.*", *_except(budgets))
    inside = Window.partitionBy("source", "_part").orderBy("sample_key", key, "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        parts.alias("p")
        .join(plan.alias("s"), F.expr("p.source <=> s.source AND p._part = s._part"))
        .select("p.*", *[f"s.{c}" for c in plan.columns if c not in ("source", "_part")])
        .withColumn("running", F.col("_start") + running)
    )
    fits = (F.col("running") <= F.col("budget")) & (F.col("budget") > 0)
    filled = placed.groupBy("source", "budget").agg(
        F.coalesce(F.max(F.when(fits, F.col("running"))), F.lit(0)).alias("filled")
    )
    gaps = filled.select("source", (F.col("budget") - F.col("filled")).alias("gap"))
    off = F.abs(F.col("gap") - F.col("size"))
    closing = (
        placed.filter(~fits & (F.col("size") > 0))
        .alias("p")
        .join(gaps.alias("g"), F.expr("p.source <=> g.source"))
        .filter(off < F.col("gap"))
        .groupBy("p.source")
        .agg(F.min(F.struct(off.alias("off"), "running")).alias("c"))
        .select("source", F.col("c.running").alias("closes"))
    )
    closed = placed.alias("p").join(closing.alias("c"), F.expr("p.source <=> c.source"), "left")
    picked = fits | ((F.col("closes") == F.col("running")) & (F.col("size") > 0))
    copies = F.col("epochs") + F.when(picked, 1).otherwise(0)
    return closed.select(
        *[f"p.{c}" for c in sized.columns],
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def _except(budgets: DataFrame) -> list[str]:
    return [f"b.{c}" for c in budgets.columns if c != "source"]


def sized(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents as rows to mix: (key, source, size, sample_key); a document labelled twice has its better label."""
    best = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("quality"))
    measured = docs.select(key, "source", size_of(F.col("text")).alias("size"))
    weight = quality_weight(F.col("quality"))
    return measured.join(best, F.col(key) == F.col("label_id"), "left").select(
        key, "source", "size", sample_key(key, weight).alias("sample_key")
    )


def repeated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: rows of `docs`, as often as the mix takes them.

    Rows that share id, source and size are alike to the mix and are given its copies in turn.
    """
    alike = ["doc_id", "source", "size"]
    numbered = F.row_number().over(Window.partitionBy(*alike).orderBy(F.lit(1)))
    plan = mixed(sized(docs, labels)).select(*alike, "copies").withColumn("n", numbered).filter("copies > 0")
    whole = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.struct("*").alias("row"))
    same = " AND ".join(f"d.{c} <=> p.{c}" for c in [*alike, "n"])
    return (
        whole.withColumn("n", numbered)
        .alias("d")
        .join(plan.alias("p"), F.expr(same))
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
