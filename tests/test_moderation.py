import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import ratings
from gleanery.functions.plurals import plural
from gleanery.operators import moderation as mod
from gleanery.operators import profanity

REVIEWS = "reviewId string, reviewerID string, summary string, reviewText string, overall string, ts long"


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame([("damn",), ("shi+",), ("a@$$",), ("s.o.b.",)], "word string")


def _profane(spark, lexicon, texts, **kw):
    pattern = profanity.profanity_pattern(lexicon, **kw)
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r.p for r in rows.select(profanity.is_profane(F.col("t"), pattern).alias("p")).collect()]


def test_lexicon_matches(spark, lexicon):
    texts = ["DAMN it", "two damns", "damnx", "shiii", "a@$$", "éDAMN", "sxoxbx"]
    assert _profane(spark, lexicon, texts) == [True, True, False, True, False, False, True]
    assert _profane(spark, lexicon, ["xdamnx"], boundaries=False) == [True]


def test_escaped_lexicon_is_literal(spark, lexicon):
    plain = profanity.escaped(lexicon)
    assert _profane(spark, plain, ["shiii", "shi+ x", "sxoxbx"], boundaries=False) == [False, True, False]


def test_empty_lexicon_is_clean(spark, lexicon):
    assert _profane(spark, lexicon.where("false"), ["damn"]) == [False]


def test_censor_masks_by_pattern_length(spark, lexicon):
    rows = spark.createDataFrame([("DAMN it",), ("two damns",), ("shiii",), ("fine",), (None,)], "t string")
    done = profanity.censor(rows, F.col("t"), lexicon)
    assert [r.censored for r in done.collect()] == ["**** it", "two *****", "****", "fine", None]
    marked = profanity.censor(rows, F.col("t"), lexicon, mark="#")
    assert marked.first().censored == "#### it"


def test_lexicon_management(spark, lexicon):
    more = spark.createDataFrame([("darn",), (" ",)], "word string")
    grown = profanity.append_words(lexicon, more)
    assert _profane(spark, grown, ["darn"]) == [True]
    cut = profanity.remove_words(grown, spark.createDataFrame([("damn",)], "word string"))
    assert _profane(spark, cut, ["damn", "darn"]) == [False, True]
    assert _profane(spark, profanity.define_words(more), ["damn", "darn"]) == [False, True]


def test_plurals(spark):
    expected = {
        "post": "posts", "octopus": "octopi", "sheep": "sheep", "CamelOctopus": "CamelOctopi",
        "person": "people", "man": "men", "woman": "women", "cow": "kine", "Kine": "Kine", "Cow": "Kine",
        "quiz": "quizzes", "box": "boxes", "lady": "ladies", "human": "humans", "child": "children",
        "": "", "status": "statuses", "shelf": "shelves", "knife": "knives", "datum": "data",
    }
    rows = spark.createDataFrame([(w,) for w in expected], "w string")
    got = {r.w: r.p for r in rows.select("w", plural(F.col("w")).alias("p")).collect()}
    assert got == expected


@pytest.mark.parametrize(
    "overall, band", [("1.0", "negative"), ("2", "negative"), ("2.5", "neutral"), ("3.0", "neutral"),
                      ("4", "positive"), ("5.0", "positive"), (None, None), ("abc", None), ("NaN", "neutral")],
)
def test_rating_band(spark, overall, band):
    row = spark.createDataFrame([(overall,)], "o string")
    got = row.select(
        ratings.rating_band(F.col("o")).alias("band"),
        ratings.agreement(F.col("o"), F.lit("positive")).alias("agrees"),
    ).first()
    assert got.band == band
    assert got.agrees == (None if band is None else band == "positive")


@pytest.mark.parametrize("c, label", [(0.05, "positive"), (-0.05, "negative"), (0.0499, "neutral"), (0.0, "neutral")])
def test_label(spark, c, label):
    row = spark.createDataFrame([(c,)], "c double")
    assert row.select(ratings.sentiment_label(F.col("c")).alias("l")).first().l == label


def _reviews(spark, impolite, clean=0, user="u1"):
    rows = [(f"r{i}", user, "Bad", "a damn awful product", "1", i) for i in range(impolite)]
    rows += [(f"c{i}", user, "Fine", "good", "5", 100 + i) for i in range(clean)]
    return spark.createDataFrame(rows, REVIEWS)


@pytest.mark.parametrize("n, banned", [(0, False), (3, False), (4, True), (6, True)])
def test_bans(spark, lexicon, n, banned):
    rows = mod.moderate(_reviews(spark, n, clean=2), lexicon)
    state = mod.user_bans(rows).first()
    assert (state.impoliteCount, state.banned) == (n, banned)


def test_ban_event_is_the_fourth_impolite_review(spark, lexicon):
    reviews = _reviews(spark, 6, clean=1)
    rows = mod.moderate(reviews, lexicon).join(reviews.select("reviewId", "ts"), "reviewId")
    event = mod.ban_events(rows, ["ts"]).collect()
    assert [(e.reviewId, e.impoliteCount) for e in event] == [("r3", 4)]
    running = mod.running_impolite(rows, ["ts"]).orderBy("impoliteCount").collect()
    assert [r.reviewId for r in running] == ["r0", "r1", "r2", "r3"]
    plan = mod.ban_events(rows, ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_redelivery(spark, lexicon):
    once = mod.moderate(_reviews(spark, 3), lexicon)
    twice = once.unionByName(once)
    assert mod.user_bans(mod.deduplicated(twice)).first().impoliteCount == 3
    assert mod.user_bans(twice).first().impoliteCount == 6


def test_missing_user_and_types(spark, lexicon):
    rows = spark.createDataFrame([("r", None, None, "ok", "abc", 0)], REVIEWS)
    row = mod.moderate(rows, lexicon).first()
    assert (row.userId, row.summary, row.overall, row.profanityCheck) == ("unknown-user", "", None, "clean")


def test_review_ids(spark):
    rows = spark.createDataFrame([("devset-000001", "a"), ("", "b"), (None, "c")], "sourceId string, reviewText string")
    first = [r.reviewId for r in mod.with_review_id(rows).collect()]
    again = [r.reviewId for r in mod.with_review_id(rows).collect()]
    assert first == again and first[0] == "devset-000001" and len(first[1]) == 64 and first[1] != first[2]
    random_ids = [r.reviewId for r in mod.with_review_id(rows, random_ids=True).collect()]
    assert len(random_ids[1]) == 36
    kept = spark.createDataFrame([("mine", "s")], "reviewId string, sourceId string")
    assert mod.with_review_id(kept).first().reviewId == "mine"


def test_sequential_ids(spark):
    rows = spark.range(1000).select((999 - F.col("id")).alias("k")).repartition(7)
    done = mod.with_sequential_id(rows, ["k"])
    assert done.where(F.expr("sourceId <> format_string('devset-%06d', k)")).count() == 0
    assert done.count() == 1000


TABLE = (
    "reviewId string, userId string, summary string, reviewText string, overall decimal(3,1), "
    "profanityCheck string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean"
)


def test_upserts_commute(spark, lexicon):
    moderated = mod.moderate(_reviews(spark, 2), lexicon)
    scored = spark.createDataFrame(
        [("r0", "negative", "-0.5", True), ("r9", "positive", "0.5", None)],
        "reviewId string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean",
    )
    empty = spark.createDataFrame([], TABLE)
    a = mod.upsert_sentiment(mod.upsert_moderation(empty, moderated), scored).orderBy("reviewId").collect()
    b = mod.upsert_moderation(mod.upsert_sentiment(empty, scored), moderated).orderBy("reviewId").collect()
    c = mod.review_table(moderated, scored).orderBy("reviewId").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [tuple(r) for r in c]
    assert {r.reviewId: r.sentiment for r in a} == {"r0": "negative", "r1": "pending", "r9": "positive"}
    # Written again, nothing changes.
    again = mod.upsert_moderation(mod.upsert_moderation(empty, moderated), moderated)
    assert again.count() == 2


def test_tally_fixture(spark):
    rows = spark.createDataFrame(
        [
            ("devset-0", "u1", "clean", "positive", True),
            ("devset-1", "u1", "clean", "negative", False),
            ("devset-2", "u2", "clean", "neutral", None),
            ("devset-3", "u2", "clean", None, None),
            ("devset-4", "u3", "impolite", "negative", True),
            ("other-5", "u3", "impolite", "negative", False),
        ],
        "reviewId string, userId string, profanityCheck string, sentiment string, ratingSentimentAgreement boolean",
    )
    users = spark.createDataFrame(
        [("u3", 5, True), ("u2", 0, False), ("u9", 7, True)], "userId string, impoliteCount long, banned boolean"
    )
    mine = mod.with_id_prefix(rows)
    one = json.loads(mod.summary(mine, users).select(F.to_json(F.struct("*")).alias("j")).first().j)
    assert one == {
        "totalReviews": 5,
        "sentimentCounts": {"negative": 2, "neutral": 1, "pending": 1, "positive": 1},
        "profanityFailCount": 1,
        "ratingSentimentComparedCount": 3,
        "ratingSentimentDisagreementCount": 1,
        "bannedUserCount": 1,
    }
    done = spark.range(1).select(mod.is_complete(mine, 5).alias("a"), mod.is_complete(mine.where("sentiment is not null"), 4).alias("b")).first()
    assert (done.a, done.b) == (False, True)


def test_ban_limit_setting(spark):
    assert mod.ban_limit(spark) == 3
    spark.conf.set(mod.BAN_LIMIT_KEY, "5")
    try:
        assert mod.ban_limit(spark) == 5
    finally:
        spark.conf.unset(mod.BAN_LIMIT_KEY)


def test_settings_fall_back_and_name_the_tables(spark):
    assert mod.settings(spark) == mod.Settings("reviews", "users", 3)
    rows = "reviewId string, userId string, summary string, reviewText string, overall double, profanityCheck string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean"
    spark.createDataFrame([("a", "u", "", "", 1.0, "impolite", None, None, None)], rows).createOrReplaceTempView("other_reviews")
    spark.createDataFrame([("u", 4, True)], "userId string, impoliteCount long, banned boolean").createOrReplaceTempView("other_users")
    spark.conf.set(mod.REVIEWS_TABLE_KEY, "other_reviews")
    spark.conf.set(mod.USERS_TABLE_KEY, " ")
    try:
        assert mod.settings(spark) == mod.Settings("other_reviews", "users", 3)
        spark.conf.set(mod.USERS_TABLE_KEY, "other_users")
        found = mod.named_summary(spark).first()
        assert (found.totalReviews, found.profanityFailCount, found.bannedUserCount) == (1, 1, 1)
        assert found.sentimentCounts == {"pending": 1}
    finally:
        spark.conf.unset(mod.REVIEWS_TABLE_KEY)
        spark.conf.unset(mod.USERS_TABLE_KEY)
