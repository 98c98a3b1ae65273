import math
import re
from collections import Counter

from corpus_cases import ODD, WORD
from pyspark.sql import functions as F

from gleanery.llm import quality_rules, queries


def counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_features_of_odd_rows(odd, empty):
    rows = quality_rules.with_features(odd.select("doc_id", "text")).collect()
    got = sorted(tuple(r.q[f] for f in [*quality_rules.FEATURES, "base_failed"]) for r in rows)
    assert got == sorted(counts(t or "") for _, t in ODD)
    assert quality_rules.with_features(empty).count() == 0


def test_binomial_tail(spark):
    cases = [(0, 10), (3, 100), (7, 1000), (0, 0), (2, 5000), (60, 100)]
    rows = spark.createDataFrame(cases, "k long, n long")
    got = {(r.k, r.n): r.p for r in rows.withColumn("p", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect()}
    for k, n in cases:
        exact = sum(math.comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(k + 1)) if k < n * 0.02 else 1.0
        assert math.isclose(got[k, n], exact, rel_tol=1e-9)


def features_with(spark, rows):
    """Rows (doc_id, lang, symbol share) as measured documents."""
    made = spark.createDataFrame(rows, "doc_id long, lang string, share double")
    zero = [F.lit(0.0).alias(n) for n in ("dup_line_share", "repeat_share")]
    words = [F.lit(5.0).alias(n) for n in ("mean_word_high", "mean_word_low")]
    q = F.struct(F.lit(False).alias("base_failed"), F.col("share").alias("symbol_share"), *zero, *words)
    return made.select("doc_id", "lang", q.alias("q"))


def test_cutoffs_keep_the_risk(spark):
    # 4000 good documents of "a", 1 % of which have a share of 0.12: only cutoffs from 0.15 on reject few enough.
    rows = [(i, "a", 0.12 if i % 100 == 0 else 0.001) for i in range(4000)] + [(9000 + i, "b", 0.0) for i in range(50)]
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    cutoffs = quality_rules.calibrate(features_with(spark, rows), labels)
    got = {(r.stratum, r.rule): (r.cutoff, r.n_good, r.n_rejected) for r in cutoffs.collect()}
    assert got["a", "symbol_share"] == (0.15, 4000, 0)
    assert not any(stratum == "b" for stratum, _ in got)  # too few to prove anything
    new = features_with(spark, [(1, "a", 0.2), (2, "a", 0.14), (3, "b", 0.9), (4, None, 0.9)])
    kept = {r.doc_id: r.kept for r in quality_rules.decide(new, cutoffs).collect()}
    assert kept == {1: False, 2: True, 3: True, 4: True}


def test_unproven_strata_take_no_pooled_cutoff(spark):
    # 4000 good documents without a language prove cutoffs, 50 of "b" and 200 of "c" prove none.
    counts = [(None, 4000), ("b", 50), ("c", 200)]
    rows = [(10000 * j + i, lang, 0.0) for j, (lang, n) in enumerate(counts) for i in range(n)]
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    cutoffs = quality_rules.calibrate(features_with(spark, rows), labels)
    assert {r.stratum for r in cutoffs.collect()} == {None}
    assert {tuple(sorted(r.tested)) for r in cutoffs.collect()} == {("b", "c")}
    new = features_with(spark, [(1, None, 0.9), (2, "b", 0.9), (3, "c", 0.9), (4, None, 0.0)])
    kept = {r.doc_id: r.kept for r in quality_rules.decide(new, cutoffs).collect()}
    assert kept == {1: False, 2: True, 3: True, 4: True}


def test_small_strata_are_pooled(spark):
    rows = [(i, f"l{i % 40}", 0.0) for i in range(8000)]
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    cutoffs = quality_rules.calibrate(features_with(spark, rows), labels, max_strata=2)
    pooled = [r for r in cutoffs.collect() if r.rule == "symbol_share"]
    assert [(r.stratum, r.n_good, r.cutoff) for r in pooled] == [(None, 38 * 200, 0.02)]


def test_filtered_keeps_columns_and_rows(odd, labels, empty):
    kept = quality_rules.filtered(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(r.text for r in kept.collect()) == sorted(t for _, t in ODD if t and not counts(t)[5])
    assert quality_rules.filtered(empty, labels).count() == 0
    assert quality_rules.filtered(odd, labels.limit(0)).count() == kept.count()
    assert quality_rules.judged(odd, labels).count() == len(ODD)


def test_query(spark, sf_dir, texts):
    rows = queries.op9_quality_rules(spark, sf_dir).collect()
    want = {i: counts(t or "") for i, t in texts}
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == want
    assert not any(r.kept for r in rows if r.base_failed)
