"""A third of all rows under one key: results stay exact, and reduction comes before the shuffle."""

import pytest
from pyspark.sql import functions as F

from gleanery.operators import collocations, moderation as mod, ranking, termstats

N = 30000


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    return spark.range(N).select(
        F.format_string("r%06d", i).alias("reviewId"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), i % 50)).alias("category"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), i % 900)).alias("userId"),
        F.when(i % 2 == 0, "impolite").otherwise("clean").alias("profanityCheck"),
        F.concat_ws(" ", F.lit("common"), F.when(i % 3 == 0, "hotword"), F.translate((i % 700 + 100).cast("string"), "0123456789", "abcdefghij")).alias("reviewText"),
    )


def _has_partial_aggregate(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    return "partial_" in plan[exchange:]


def test_hot_category(hot):
    scores = termstats.chi2_scores(hot)
    top = ranking.top_terms(scores, 3).where("category = 'hot'").orderBy("rank").collect()
    assert top[0].term == "hotword" and top[0].chi2 == pytest.approx(N)
    counts = termstats.term_category_counts(hot)
    assert counts.where("term = 'common' and category = 'hot'").first().a == N // 3
    assert _has_partial_aggregate(counts)


def test_hot_user(hot):
    bans = mod.user_bans(hot)
    assert bans.where("userId = 'hot'").first().impoliteCount == N // 6
    assert bans.agg(F.sum("impoliteCount")).first()[0] == N // 2
    assert _has_partial_aggregate(bans)
    event = mod.ban_events(hot, ["reviewId"]).where("userId = 'hot'").collect()
    assert [e.reviewId for e in event] == ["r000018"]


def test_many_copies_of_one_review(hot):
    copies = hot.select(F.lit("same").alias("reviewId"), F.lit("u1").alias("userId"), F.lit("impolite").alias("profanityCheck"))
    rows = hot.select("reviewId", "userId", "profanityCheck").unionByName(copies.limit(N // 2))
    once = mod.deduplicated(rows)
    assert once.count() == N + 1
    assert _has_partial_aggregate(once)


def test_hot_word_pairs(hot):
    pairs = collocations.bigrams(hot, F.split("reviewText", " "))
    row = pairs.where("w1 = 'common' and w2 = 'hotword'").first()
    assert (row["count"], row.n_ix, row.n_xi) == (N // 3, N, N // 3)


def test_no_join_without_keys(hot):
    top = ranking.top_terms(termstats.chi2_scores(hot))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
