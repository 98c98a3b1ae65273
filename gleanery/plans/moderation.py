"""Registered queries: politeness, bans, rating agreement, upserts and the tally."""

import uuid

from pyspark.sql import functions as F

from gleanery.functions import ratings
from gleanery.functions.plurals import PLURAL_RULES, UNCOUNTABLE, plural
from gleanery.functions.tokenize import letter_words, merged_text
from gleanery.operators import moderation as mod
from gleanery.operators import valence
from gleanery.plans.inputs import (
    BAD_PLURALS,
    BAD_WORDS,
    MERGED_SQL,
    REVIEWS_CTE,
    SQL_OUTSIDE,
    bad_words,
    sql_list,
    sql_profane,
    valence_lexicon,
)
from gleanery.plans.valence_sql import VALENCE_CTE, corpus_rules
from gleanery.sinks import keyed_table
from gleanery.sources.tables import reviews, shared_dir, table


def _identified(spark, sf_dir):
    return mod.with_review_id(reviews(spark, sf_dir))


def _moderated(spark, sf_dir):
    return mod.moderate(_identified(spark, sf_dir), bad_words(spark))


def _sentiments(spark, sf_dir):
    rows = _identified(spark, sf_dir)
    text = merged_text(F.col("summary"), F.col("reviewText"))
    scores = valence.polarity_scores(
        rows, valence_lexicon(spark), text=text, rules=corpus_rules()
    )
    return scores.select("reviewId", "compound")


def _labelled(rows, scores):
    label = ratings.sentiment_label(F.col("compound"))
    return rows.join(scores, "reviewId").select(
        "reviewId",
        label.alias("sentiment"),
        F.col("compound").cast("string").alias("sentimentScore"),
        ratings.agreement(F.col("overall"), label).alias("ratingSentimentAgreement"),
    )


def _scored_reviews(spark, sf_dir):
    """Sentiment columns of all reviews."""
    rows = _identified(spark, sf_dir)
    return _labelled(rows.select("reviewId", "overall"), _sentiments(spark, sf_dir))


def _review_table(spark, sf_dir):
    return mod.review_table(_moderated(spark, sf_dir), _scored_reviews(spark, sf_dir))


def moderated_reviews(spark, sf_dir):
    return _moderated(spark, sf_dir).withColumn("overall", F.col("overall").cast("double"))


def censored_text(spark, sf_dir):
    return mod.censored(_identified(spark, sf_dir), bad_words(spark))


def plural_forms(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(
        F.explode(F.array_distinct(letter_words(F.col("text")))).alias("word")
    )
    return words.distinct().select("word", plural(F.col("word")).alias("plural"))


def user_bans(spark, sf_dir):
    return mod.user_bans(_moderated(spark, sf_dir), mod.ban_limit(spark))


def ban_events(spark, sf_dir):
    return mod.ban_events(_moderated(spark, sf_dir), ["reviewId"], mod.ban_limit(spark)).select(
        "userId", "reviewId", "impoliteCount"
    )


def running_impolite(spark, sf_dir):
    running = mod.running_impolite(_moderated(spark, sf_dir), ["reviewId"], mod.ban_limit(spark))
    return running.select("userId", "reviewId", "impoliteCount")


def _event_log(spark, sf_dir):
    """The event stream as a moderation log; an error counts as impolite."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reviewId"),
        F.col("user_id").cast("string").alias("userId"),
        "ts",
        ratings.politeness_label(F.col("event_type") == "error").alias("profanityCheck"),
    )


def event_bans(spark, sf_dir):
    return mod.user_bans(_event_log(spark, sf_dir), mod.ban_limit(spark))


def event_ban_moments(spark, sf_dir):
    return mod.ban_events(_event_log(spark, sf_dir), ["ts", "reviewId"], mod.ban_limit(spark)).select(
        "userId", F.col("reviewId").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("banned_at")
    )


def deduplicated_events(spark, sf_dir):
    """At-least-once delivery: every event arrives twice and counts once."""
    log = _event_log(spark, sf_dir)
    return mod.user_bans(mod.deduplicated(log.unionByName(log)))


def rating_band(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        F.col("sourceId").alias("reviewId"), "overall", ratings.rating_band(F.col("overall")).alias("band")
    )


def rating_agreement(spark, sf_dir):
    rows = _identified(spark, sf_dir)
    return _labelled(rows, _sentiments(spark, sf_dir)).select(
        "reviewId", "sentiment", "ratingSentimentAgreement"
    )


def review_table(spark, sf_dir):
    return _review_table(spark, sf_dir).select(
        "reviewId",
        "userId",
        F.col("overall").cast("double").alias("overall"),
        "profanityCheck",
        "sentiment",
        F.col("sentimentScore").cast("double").alias("compound"),
        "ratingSentimentAgreement",
    )


def _empty_table(spark):
    strings = ", ".join(f"{c} string" for c in ("reviewId", "userId", "summary", "reviewText"))
    kinds = "overall decimal(3,1), profanityCheck string, sentiment string, sentimentScore string"
    return spark.createDataFrame([], f"{strings}, {kinds}, ratingSentimentAgreement boolean")


def _merged(table_):
    return table_.select("reviewId", "userId", "profanityCheck", "sentiment", "ratingSentimentAgreement")


def review_upserts(spark, sf_dir):
    """The same table from both keyed upserts, sentiment first; equal to `review_table`."""
    stored = mod.upsert_sentiment(_empty_table(spark), _scored_reviews(spark, sf_dir))
    return _merged(mod.upsert_moderation(stored, _moderated(spark, sf_dir)))


def sentiment_upserts(spark, sf_dir):
    """Sentiment written over moderated reviews."""
    stored = mod.upsert_moderation(_empty_table(spark), _moderated(spark, sf_dir))
    return _merged(mod.upsert_sentiment(stored, _scored_reviews(spark, sf_dir)))


BUCKETS = 16


def bucketed_upserts(spark, sf_dir):
    """Both consumers' upserts into a table in buckets, moderation first; equal to `review_table`."""
    root = f"{shared_dir(spark)}/reviews-{uuid.uuid4().hex}"
    keyed_table.create(spark, root)
    keyed_table.upsert(root, _moderated(spark, sf_dir), mod.upsert_moderation, BUCKETS)
    keyed_table.upsert(root, _scored_reviews(spark, sf_dir), mod.upsert_sentiment, BUCKETS)
    return _merged(keyed_table.read(spark, root))


def sentiment_histogram(spark, sf_dir):
    return mod.sentiment_histogram(_review_table(spark, sf_dir))


def review_summary(spark, sf_dir):
    return mod.tally(_review_table(spark, sf_dir))


def _users(spark, sf_dir):
    return mod.user_bans(_moderated(spark, sf_dir), mod.ban_limit(spark))


def banned_users(spark, sf_dir):
    rows = mod.with_id_prefix(_moderated(spark, sf_dir))
    return mod.banned_users(rows, _users(spark, sf_dir))


def summary_json(spark, sf_dir):
    rows = mod.with_id_prefix(_review_table(spark, sf_dir))
    one = mod.summary(rows, _users(spark, sf_dir))
    return one.select(F.to_json(F.struct("*")).alias("summary"))


def named_summary(spark, sf_dir):
    """The summary over tables whose names the session sets, here views over the given documents."""
    names = {mod.REVIEWS_TABLE_KEY: f"reviews_{uuid.uuid4().hex}", mod.USERS_TABLE_KEY: f"users_{uuid.uuid4().hex}"}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, name in names.items():
        spark.conf.set(key, name)
    try:
        mod.with_id_prefix(_review_table(spark, sf_dir)).createTempView(names[mod.REVIEWS_TABLE_KEY])
        _users(spark, sf_dir).createTempView(names[mod.USERS_TABLE_KEY])
        return mod.named_summary(spark).select(F.to_json(F.struct("*")).alias("summary"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def pipeline_complete(spark, sf_dir):
    table_ = _review_table(spark, sf_dir)
    expected = reviews(spark, sf_dir).agg(F.count("*").alias("n"))
    counts = mod.tally(table_).withColumn("expected", expected.scalar())
    done = (F.col("totalReviews") >= F.col("expected")) & (F.col("pendingCount") == 0)
    return counts.select("expected", "totalReviews", "pendingCount", done.alias("complete"))


def sequential_ids(spark, sf_dir):
    rows = reviews(spark, sf_dir).drop("sourceId").select("doc_id", "category")
    return mod.with_sequential_id(rows, ["category", "doc_id"]).select("doc_id", "sourceId")


QUERIES = {
    "moderated_reviews": moderated_reviews,
    "censored_text": censored_text,
    "plural_forms": plural_forms,
    "user_bans": user_bans,
    "ban_events": ban_events,
    "running_impolite": running_impolite,
    "event_bans": event_bans,
    "event_ban_moments": event_ban_moments,
    "deduplicated_events": deduplicated_events,
    "rating_band": rating_band,
    "rating_agreement": rating_agreement,
    "review_table": review_table,
    "review_upserts": review_upserts,
    "sentiment_upserts": sentiment_upserts,
    "bucketed_upserts": bucketed_upserts,
    "sentiment_histogram": sentiment_histogram,
    "review_summary": review_summary,
    "banned_users": banned_users,
    "summary_json": summary_json,
    "named_summary": named_summary,
    "pipeline_complete": pipeline_complete,
    "sequential_ids": sequential_ids,
}

_LABEL = """CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative'
            ELSE 'neutral' END"""
_BAND = """CASE WHEN overall <= 2 THEN 'negative' WHEN overall >= 4 THEN 'positive'
           WHEN overall IS NOT NULL THEN 'neutral' END"""
_MODERATED = f"""WITH {REVIEWS_CTE},
moderated AS (
  SELECT sourceId AS reviewId, coalesce(reviewerID, 'unknown-user') AS userId,
         coalesce(summary, '') AS summary, coalesce(reviewText, '') AS reviewText, overall,
         CASE WHEN {sql_profane(MERGED_SQL)} THEN 'impolite' ELSE 'clean' END AS profanityCheck
  FROM reviews),
users AS (SELECT userId, count(*) FILTER (profanityCheck = 'impolite') AS impoliteCount
          FROM moderated GROUP BY userId),
running AS (SELECT userId, reviewId, row_number() OVER (PARTITION BY userId ORDER BY reviewId) AS impoliteCount
            FROM moderated WHERE profanityCheck = 'impolite')"""

_TABLE = f"""{_MODERATED}, {VALENCE_CTE},
labelled AS (SELECT r.sourceId AS reviewId, compound, {_LABEL} AS sentiment, ({_BAND}) = ({_LABEL}) AS agrees
             FROM reviews r JOIN scores ON scores.reviewId = r.sourceId),
review_table AS (
  SELECT coalesce(m.reviewId, l.reviewId) AS reviewId, userId, overall, profanityCheck,
         coalesce(sentiment, 'pending') AS sentiment, compound, agrees AS ratingSentimentAgreement
  FROM moderated m FULL JOIN labelled l ON m.reviewId = l.reviewId),
histogram AS (SELECT sentiment, count(*) AS n_reviews FROM review_table GROUP BY sentiment),
counts AS (
  SELECT count(*) AS totalReviews,
         count(*) FILTER (profanityCheck = 'impolite') AS profanityFailCount,
         count(ratingSentimentAgreement) AS ratingSentimentComparedCount,
         count(*) FILTER (NOT ratingSentimentAgreement) AS ratingSentimentDisagreementCount,
         count(*) FILTER (sentiment = 'pending') AS pendingCount
  FROM review_table)"""


def _censored(text: str) -> str:
    by_size: dict[int, list[str]] = {}
    for word in BAD_WORDS + BAD_PLURALS:
        by_size.setdefault(len(word), []).append(word)
    for size in sorted(by_size, reverse=True):
        find = f"(?i)(^|{SQL_OUTSIDE})(?:{'|'.join(sorted(by_size[size]))})($|{SQL_OUTSIDE})"
        # Neighbouring hits share a blank, so a second pass takes the ones the first left.
        for _ in range(2):
            text = f"regexp_replace({text}, '{find}', '\\1{'*' * size}\\2', 'g')"
    return text


def _plural_case(word: str) -> str:
    whens = []
    for pattern, replacement in PLURAL_RULES:
        if pattern == "$":
            whens.append(f"ELSE {word} || 's'")
        else:
            new = replacement.replace("$", "\\")
            whens.append(f"WHEN regexp_matches({word}, '{pattern}') THEN regexp_replace({word}, '{pattern}', '{new}')")
    return f"CASE WHEN {word} = '' OR lower({word}) IN ({sql_list(UNCOUNTABLE)}) THEN {word} {' '.join(whens)} END"


_EVENT_USERS = """SELECT CAST(user_id AS VARCHAR) AS userId,
       count(*) FILTER (event_type = 'error') AS impoliteCount,
       count(*) FILTER (event_type = 'error') > 3 AS banned
FROM events GROUP BY user_id"""

SQL = {
    "moderated_reviews": f"{_MODERATED} SELECT * FROM moderated",
    "censored_text": f"WITH {REVIEWS_CTE} SELECT sourceId AS reviewId, {_censored(MERGED_SQL)} AS text FROM reviews",
    "plural_forms": f"""SELECT word, {_plural_case('word')} AS plural FROM (
        SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM documents)
        WHERE word <> ''""",
    "user_bans": f"{_MODERATED} SELECT userId, impoliteCount, impoliteCount > 3 AS banned FROM users",
    "ban_events": f"{_MODERATED} SELECT * FROM running WHERE impoliteCount = 4",
    "running_impolite": f"{_MODERATED} SELECT * FROM running WHERE impoliteCount <= 4",
    "event_bans": _EVENT_USERS,
    "event_ban_moments": """SELECT userId, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS banned_at FROM (
        SELECT CAST(user_id AS VARCHAR) AS userId, event_id, ts,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events WHERE event_type = 'error') WHERE n = 4""",
    "deduplicated_events": _EVENT_USERS,
    "rating_band": f"WITH {REVIEWS_CTE} SELECT sourceId AS reviewId, overall, {_BAND} AS band FROM reviews",
    "rating_agreement": f"{_TABLE} SELECT reviewId, sentiment, agrees AS ratingSentimentAgreement FROM labelled",
    "review_table": f"{_TABLE} SELECT * FROM review_table",
    "review_upserts": f"""{_TABLE} SELECT reviewId, userId, profanityCheck, sentiment,
        ratingSentimentAgreement FROM review_table""",
    "bucketed_upserts": f"""{_TABLE} SELECT reviewId, userId, profanityCheck, sentiment,
        ratingSentimentAgreement FROM review_table""",
    "sentiment_upserts": f"""{_TABLE}
        SELECT l.reviewId, userId, profanityCheck, sentiment, agrees AS ratingSentimentAgreement FROM labelled l
        LEFT JOIN moderated m ON m.reviewId = l.reviewId""",
    "sentiment_histogram": f"{_TABLE} SELECT * FROM histogram",
    "review_summary": f"{_TABLE} SELECT * FROM counts",
    "banned_users": f"""{_MODERATED} SELECT userId, impoliteCount FROM users WHERE impoliteCount > 3
        AND userId IN (SELECT userId FROM moderated WHERE reviewId LIKE 'devset-%')""",
    "summary_json": f"""{_TABLE} SELECT '{{"totalReviews":' || totalReviews || ',"sentimentCounts":{{'
        || (SELECT string_agg('"' || sentiment || '":' || n_reviews, ',' ORDER BY sentiment) FROM histogram)
        || '}},"profanityFailCount":' || profanityFailCount
        || ',"ratingSentimentComparedCount":' || ratingSentimentComparedCount
        || ',"ratingSentimentDisagreementCount":' || ratingSentimentDisagreementCount
        || ',"bannedUserCount":' || (SELECT count(*) FROM users WHERE impoliteCount > 3)
        || '}}' AS summary FROM counts""",
    "pipeline_complete": f"""{_TABLE} SELECT (SELECT count(*) FROM reviews) AS expected, totalReviews, pendingCount,
        totalReviews >= (SELECT count(*) FROM reviews) AND pendingCount = 0 AS complete FROM counts""",
    "sequential_ids": """SELECT doc_id, printf('devset-%06d', row_number() OVER (ORDER BY source, doc_id) - 1)
        AS sourceId FROM documents""",
}
SQL["named_summary"] = SQL["summary_json"]
