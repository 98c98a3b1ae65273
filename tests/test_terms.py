import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanery.functions.tokenize import merged_text, tokens
from gleanery.operators import features, ranking, termstats

MICRO = [
    ("Book", "reading great novel reading"),
    ("Book", "novel chapter reading"),
    ("Music", "guitar music great"),
    ("Music", "music concert"),
    ("Pet", "cat toy great"),
    ("Pet", "cat litter"),
]


@pytest.fixture
def micro(spark):
    return spark.createDataFrame(MICRO, "category string, reviewText string")


@pytest.fixture
def stop(spark):
    return spark.createDataFrame([("novel",), ("guitar",), ("toy",)], "word string")


def _tokens(spark, text, tokenizer, min_length=1):
    row = spark.createDataFrame([(text,)], "t string").select(
        tokens(F.col("t"), tokenizer, min_length).alias("x")
    )
    return row.first().x


def test_tokenisers(spark):
    assert _tokens(spark, "Foo bar a*b\x1cc ÉTÉ 12x", "unicode") == ["foo", "bar", "a", "b", "c", "été", "x"]
    assert _tokens(spark, "a*b\nc great*deal", "blank_tab") == ["a*b\nc", "great*deal"]
    assert _tokens(spark, "a bc d", "unicode", 2) == ["bc"]
    assert _tokens(spark, None, "unicode") == []


def test_micro_scores(micro, stop):
    rows = {(r.category, r.term): r for r in termstats.chi2_scores(micro, stop).collect()}
    assert rows[("Book", "reading")].chi2 == 6.0
    assert rows[("Book", "chapter")].chi2 == pytest.approx(2.4)
    assert rows[("Book", "great")].chi2 == 0.0
    r = rows[("Book", "great")]
    assert (r.a, r.b, r.c, r.d) == (1, 2, 1, 2)


def test_ranked_lines(micro, stop):
    top = ranking.top_terms(termstats.chi2_scores(micro, stop))
    lines = [r.line for r in ranking.ranked_lines(top).orderBy("part", "category").collect()]
    assert lines == [
        "Book reading:6.0000 chapter:2.4000 great:0.0000",
        "Music music:6.0000 concert:2.4000 great:0.0000",
        "Pet cat:6.0000 litter:2.4000 great:0.0000",
        "cat chapter concert great litter music reading",
    ]


def test_degenerate_margins(spark, stop):
    rows = spark.createDataFrame([(c, t + " zzz") for c, t in MICRO], "category string, reviewText string")
    closed = termstats.chi2_scores(rows, stop).where("term = 'zzz'").collect()
    assert closed == []
    expected = termstats.chi2_scores(rows, stop, form="expected").where("term = 'zzz'").collect()
    assert [r.chi2 for r in expected] == [0.0, 0.0, 0.0]


def test_category_and_text_rules(spark, micro):
    extra = spark.createDataFrame(
        [(None, "cat"), ("", "cat"), ("Pet", None)], "category string, reviewText string"
    )
    rows = micro.unionByName(extra)
    sizes = {r.category: r.n_c for r in termstats.category_sizes(rows).collect()}
    assert sizes == {"Book": 2, "Music": 2, "Pet": 3}
    assert rows.select(termstats.corpus_size(rows).alias("n")).first().n == 7


def test_closed_equals_expected_form(spark):
    rng = random.Random(7)
    words = [f"w{i}x" for i in range(30)]
    words = [w.replace(str(i), "abcdefghij"[i % 10] * (1 + i // 10)) for i, w in enumerate(words)]
    docs = [(f"c{rng.randrange(4)}", " ".join(rng.choices(words, k=8))) for _ in range(80)]
    rows = spark.createDataFrame(docs, "category string, reviewText string")
    closed = {(r.term, r.category): r.chi2 for r in termstats.chi2_scores(rows).collect()}
    other = {(r.term, r.category): r.chi2 for r in termstats.chi2_scores(rows, form="expected").collect()}
    assert closed and set(closed) <= set(other)
    for key, value in closed.items():
        assert math.isclose(value, other[key], rel_tol=1e-9, abs_tol=1e-9)
    # Brute force over sets of words.
    n = len(docs)
    sizes = Counter(c for c, _ in docs)
    with_term = Counter((t, c) for c, text in docs for t in set(text.split()))
    totals = Counter(t for _, text in docs for t in set(text.split()))
    for (t, c), value in closed.items():
        a = with_term[(t, c)]
        b, cc = totals[t] - a, sizes[c] - a
        d = n - a - b - cc
        assert math.isclose(
            value, n * (a * d - b * cc) ** 2 / ((a + b) * (a + cc) * (b + d) * (cc + d)), rel_tol=1e-12
        )


def test_same_result_on_any_partitioning(micro, stop):
    one = termstats.chi2_scores(micro.coalesce(1), stop).orderBy("category", "term").collect()
    many = termstats.chi2_scores(micro.repartition(7), stop).orderBy("category", "term").collect()
    assert one == many


def test_top_k_breaks_ties_by_term_and_limits_before_the_shuffle(spark):
    rows = spark.createDataFrame([("c", f"t{i:02d}", 1.0) for i in range(20)], "category string, term string, chi2 double")
    top = ranking.top_terms(rows, 5)
    assert [r.term for r in top.orderBy("rank").collect()] == [f"t{i:02d}" for i in range(5)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_formatting_rounds_halves_to_even(spark):
    top = spark.createDataFrame([("c", "a", 0.03125, 1), ("c", "b", 2.00005, 2)], "category string, term string, chi2 double, rank int")
    line = ranking.ranked_lines(top).where("part = 0").first().line
    assert line == "c a:0.0312 b:2.0000"


def test_counts_records_and_statistics(micro, stop):
    counts = termstats.term_category_counts(micro, stop)
    records = termstats.count_records(counts, micro).collect()
    assert sum(r.cnt for r in records if r.kind == "n") == 6
    assert {r.category: r.cnt for r in records if r.kind == "c"} == {"Book": 2, "Music": 2, "Pet": 2}
    great = termstats.term_statistics(counts).where("term = 'great'").first()
    assert great.total == 3 and great.categories == {"Book": 1, "Music": 1, "Pet": 1}


def test_merged_text_keeps_the_blank(spark):
    row = spark.createDataFrame([(None, "ok")], "s string, b string")
    assert row.select(merged_text(F.col("s"), F.col("b")).alias("t")).first().t == " ok"
    assert row.select(merged_text(F.col("s"), F.col("b"), "None").alias("t")).first().t == "None ok"


def test_small_tables_are_broadcast_by_measured_size(spark, micro, stop):
    """Without static size estimates, the finished shuffle of the category sizes decides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    try:
        scores = termstats.chi2_scores(micro)
        scores.collect()
        # The first plan sorts and merges; only a plan made at run time can broadcast.
        plan = scores._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [category" in plan and "SortMergeJoin [category" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_chi_square_of_a_corpus_beyond_the_range_of_products(spark):
    cells = spark.createDataFrame(
        [("t", "c", 40_000_000_000, 10**9, 10**9, 10**9, 37_000_000_000)],
        "term string, category string, n long, a long, b long, c long, d long",
    )
    (closed,) = termstats.chi2_closed(cells).collect()
    (expected,) = termstats.chi2_expected(cells).collect()
    assert abs(closed.chi2 / expected.chi2 - 1) < 1e-9 and closed.chi2 > 8e9


def test_feature_chi_square_of_a_large_corpus(spark):
    # Counts of documents above 4e9 as sizes; two terms of one document each keep the table small.
    terms = spark.createDataFrame([("t", 1, "a"), ("t", 2, "b")], "term string, tf long, category string")
    sizes = spark.createDataFrame([("a", 6 * 10**9), ("b", 5 * 10**9)], "category string, n_c long")
    n = F.lit(11 * 10**9)
    (row,) = features.feature_chi2(terms, sizes, n, F.lit(2)).collect()
    # One document of a in level 1, one of b in level 2: n * (1/n_a + 1/n_b + rest - 1)
    rest = sum((s - 1) ** 2 / (s * (11e9 - 2)) for s in (6e9, 5e9))
    assert abs(row.chi2 - 11e9 * (1 / 6e9 + 1 / 5e9 + rest - 1)) < 1e-3 and row.dof == 2
