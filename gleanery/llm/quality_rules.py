"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Each rule rejects a document whose value lies beyond a cutoff. Labelled good documents (the holdout) decide how far a
cutoff may go: in a stratum with n of them, of which a cutoff rejects k, the exact binomial probability of seeing at
most k rejections, were the true rate `risk` or more, must not exceed the error level. Cutoffs of a rule are
tested from the most lenient on and testing stops at the first failure (a fixed sequence, which needs no correction);
the level is divided by the number of sequences, strata times rules (Bonferroni). The risk of a rule is the total risk
divided by the number of rules, so that all rules together reject at most `risk` of the good documents of any
stratum, with probability 1 - `level`.

A null text has no words. A null stratum, and all but the `max_strata` strata with the most labels, are pooled into
one stratum of their own. Without labels no cutoff can be proven and only the base rule rejects. A stratum that was
tested and proved nothing has no cutoff, and takes none of the pooled stratum's. A document labelled more than once counts once, and as good only if every label says so. Extra columns of the input are kept.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.frames import SPACES, WORD_CHARACTER, kept, let

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

#: Rule: (sign, cutoffs from lenient to strict). A document is rejected if sign * value > sign * cutoff.
RULES = {
    "symbol_share": (1, [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02]),
    "dup_line_share": (1, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "repeat_share": (1, [0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "mean_word_high": (1, [40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0]),
    "mean_word_low": (-1, [1.0, 1.5, 2.0, 2.5, 3.0, 3.5]),
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _covered(grams: Column) -> Column:
    """Words in windows that occur more than once; `grams` has the hash of each window in text order."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
            | ((i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"])),
        )
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        let(pairs, positions),
        start,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )


def _doubled(hashes: Column, width: int) -> Column:
    """Hashes of windows twice as wide, from those of `width` words that start `width` words apart."""
    n = F.size(hashes) - width
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, width + 1, n), lambda a, b: F.xxhash64(a, b))


def _repeated(hashes: Column) -> Column:
    grams = let(_doubled(hashes, 1), lambda two: let(_doubled(two, 2), lambda four: _doubled(four, 4)))
    repeated = let(
        grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), _covered(g)).otherwise(F.lit(0))
    )
    return F.when(F.size(hashes) > WINDOW, repeated).otherwise(F.lit(0)).cast("long")


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the column `q`, a struct of the counts and of the rules' values.

    No shuffle: each text is measured in its own row, in time that grows as its length (times its logarithm where
    windows repeat).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_CHARACTER))
    of_words = let(
        words(body),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            let(F.transform(w, lambda x: F.xxhash64(x)), _repeated).alias("r"),
        ),
    )
    of_lines = let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))
    )
    symbols = F.regexp_count(body, F.lit(SYMBOLS)).cast("long")
    counts = F.struct(of_words.alias("w"), of_lines.alias("l"), symbols.alias("symbols"))

    def named(c: Column) -> Column:
        share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
        n, repeats, dups = c["w"]["n"], c["w"]["r"], c["l"]["n"] - c["l"]["d"]
        return F.struct(
            n.alias("n_words"),
            c["w"]["chars"].alias("word_chars"),
            c["symbols"].alias("n_symbols"),
            dups.alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
            ((n < 20) | (100 * repeats > 30 * n)).alias("base_failed"),
            share(c["symbols"], c["w"]["chars"]).alias("symbol_share"),
            share(dups, c["l"]["n"]).alias("dup_line_share"),
            share(repeats, n).alias("repeat_share"),
            share(c["w"]["chars"], n).alias("mean_word_high"),
            share(c["w"]["chars"], n).alias("mean_word_low"),
        )

    return docs.withColumn("q", let(counts, named))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial X with n draws of probability `rate`; summed in logarithms."""
    odds = F.log(F.lit(rate / (1 - rate)))
    first = n * F.log(F.lit(1 - rate))
    step = lambda s, i: F.struct(
        (s["term"] + F.log((n - i + 1) / i) + odds).alias("term"),
        (
            s["total"]
            + F.log1p(F.exp(s["term"] + F.log((n - i + 1) / i) + odds - s["total"]))
        ).alias("total"),
    )
    ones = F.filter(F.sequence(F.lit(0), k.cast("int")), lambda i: i > 0)
    total = F.aggregate(ones, F.struct(first.alias("term"), first.alias("total")), step, lambda s: s["total"])
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(total))


def calibrate(
    features: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    key: str = "doc_id",
    quality: str = "quality",
    risk: float = 0.02,
    level: float = 0.05,
    max_strata: int = 64,
    rules: dict = RULES,
) -> DataFrame:
    """Proven cutoffs: stratum (null: the pooled one), rule, cutoff, n_good, n_rejected, tested.

    `tested` names every stratum that has tests of its own, whether or not they proved a cutoff.

    `features` has `key`, `stratum` and `q`. Only documents that pass the base rule are in the holdout, since only
    they can be rejected by these rules. Counts are partial per task; what follows has a row for each stratum, rule
    and cutoff.
    """
    good = labels.groupBy(F.col(key).alias("label_key")).agg(F.min(quality).alias("good"))
    holdout = (
        features.join(good, features[key] == good["label_key"])
        .filter((F.col("good") == 1) & ~F.col("q.base_failed"))
        .select(F.col(stratum).alias("stratum"), "q")
    )
    strict = [(name, sign, c) for name, (sign, cutoffs) in rules.items() for c in cutoffs]
    counts = [
        F.sum((sign * F.col(f"q.{name}") > sign * c).cast("long")).alias(f"k{i}")
        for i, (name, sign, c) in enumerate(strict)
    ]
    by_stratum = holdout.groupBy("stratum").agg(F.count("*").alias("n_good"), *counts)
    place = F.row_number().over(Window.orderBy(F.col("n_good").desc(), F.col("stratum").asc_nulls_last()))
    pooled = (
        by_stratum.withColumn("stratum", F.when(place <= max_strata, F.col("stratum")))
        .groupBy("stratum")
        .agg(F.sum("n_good").alias("n_good"), *[F.sum(f"k{i}").alias(f"k{i}") for i in range(len(strict))])
    )
    everything = Window.partitionBy(F.lit(1))
    tests = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(rules[name][1].index(c)).alias("step"),
                F.lit(c).alias("cutoff"),
                F.col(f"k{i}").alias("n_rejected"),
            )
            for i, (name, _, c) in enumerate(strict)
        ]
    )
    tested = (
        pooled.withColumn("s", F.count("*").over(everything))
        .withColumn("tested", F.collect_set("stratum").over(everything))
        .select("stratum", "n_good", "s", "tested", F.inline(tests))
        .withColumn("p", binomial_tail(F.col("n_rejected"), F.col("n_good"), risk / len(rules)))
        .withColumn("passed", F.col("p") <= F.lit(level) / (F.col("s") * len(rules)))
    )
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    proven = tested.withColumn("passed", F.min("passed").over(so_far)).filter("passed")
    last = F.struct("step", "cutoff", "n_good", "n_rejected", "tested")
    return proven.groupBy("stratum", "rule").agg(F.max(last).alias("t")).select("stratum", "rule", "t.*").drop("step")


def decide(features: DataFrame, cutoffs: DataFrame, stratum: str = "lang", rules: dict = RULES) -> DataFrame:
    """Add `kept`: neither the base rule nor a proven cutoff of the document's stratum rejects it.

    The pooled cutoffs go to the documents of no tested stratum.

    The cutoffs, at most (max_strata + 1) rows a rule, become constants of the plan, so the documents aren't shuffled.
    """
    proven = cutoffs.collect()
    strata = {name for r in proven for name in r["tested"]}
    group = F.when(F.col(stratum).isin(*strata), F.col(stratum)) if strata else F.lit(None).cast("string")
    rejected = [F.col("q.base_failed")]
    for name, (sign, _) in rules.items():
        known = [r for r in proven if r["rule"] == name]
        if known:
            cutoff = F.coalesce(
                *[F.when(group.eqNullSafe(F.lit(r["stratum"])), F.lit(float(r["cutoff"]))) for r in known]
            )
            rejected.append(F.coalesce(sign * F.col(f"q.{name}") > sign * cutoff, F.lit(False)))
    return features.withColumn("kept", ~reduce(Column.__or__, rejected))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents' ids with their counts and verdicts; the texts are read once."""
    measured = kept(with_features(docs).select("doc_id", "lang", "q"))
    return decide(measured, calibrate(measured, labels)).select(
        "doc_id", *[f"q.{name}" for name in FEATURES], "q.base_failed", "kept"
    )


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, each row judged by its own text.

    Texts are measured twice, once for the cutoffs and once to be judged, and never shuffled or stored.
    """
    columns = ["doc_id", "lang", "text"]
    cutoffs = calibrate(with_features(docs.select(*columns)).select("doc_id", "lang", "q"), labels)
    rows = docs.select(*columns, F.struct("*").alias("row"))
    return decide(with_features(rows), cutoffs).filter("kept").select("row.*")
