"""Registered queries: the streaming dataflow run to the end of the given tables, and arrivals."""

import uuid

from pyspark.sql import functions as F

from gleanery.operators import moderation as mod
from gleanery.plans.inputs import bad_words, valence_lexicon
from gleanery.plans.moderation import SQL as BATCH_SQL
from gleanery.plans.valence_sql import corpus_rules
from gleanery.functions import ratings
from gleanery.functions.tokenize import merged_text
from gleanery.operators import valence
from gleanery.schemas import DOCUMENT
from gleanery.sources.arrivals import envelope_records, stream_table
from gleanery.sources.tables import review_view, shared_dir, table
from gleanery.streaming import review_stream as rs


#: Seconds since 1970; a row at 0 would be late from the start.
FIRST_ARRIVAL = 1_600_000_000


def _work_dir(spark) -> str:
    return f"{shared_dir(spark)}/review-stream-{uuid.uuid4().hex}"


def _review_stream(spark, sf_dir):
    # A glob, so that the table may be one file or a folder of files.
    documents = stream_table(spark, f"{sf_dir}/documents.parquet*", DOCUMENT)
    return mod.with_review_id(review_view(documents))


def _moderated_stream(spark, sf_dir):
    return mod.moderate(_review_stream(spark, sf_dir), bad_words(spark))


def stream_moderation(spark, sf_dir):
    """Arriving reviews -> politeness columns -> append sink."""
    work = _work_dir(spark)
    rs.run_available(
        rs.start_append(_moderated_stream(spark, sf_dir), f"{work}/moderated", f"{work}/cp")
    )
    return (
        spark.read.parquet(f"{work}/moderated")
        .select("reviewId", "userId", F.col("overall").cast("double").alias("overall"), "profanityCheck")
    )


def _run_user_counts(spark, sf_dir):
    work = _work_dir(spark)
    log = f"{work}/users"
    moderated = _moderated_stream(spark, sf_dir)
    rs.run_available(rs.start_user_counts(moderated, log, f"{work}/cp", mod.ban_limit(spark)))
    return log


def stream_user_bans(spark, sf_dir):
    """Arriving reviews -> keyed user state, deduplicated by review id."""
    return rs.users_table(spark, _run_user_counts(spark, sf_dir))


def stream_ban_reports(spark, sf_dir):
    log = _run_user_counts(spark, sf_dir)
    return rs.ban_reports(spark, log).join(rs.users_table(spark, log), "userId").select(
        "userId", "impoliteCount"
    )


def _scored(rows, lexicon, rules):
    text = merged_text(F.col("summary"), F.col("reviewText"))
    scores = valence.polarity_scores(rows, lexicon, text=text, rules=rules)
    label = ratings.sentiment_label(F.col("compound"))
    return rows.join(scores, "reviewId").select(
        "reviewId",
        label.alias("sentiment"),
        F.col("compound").cast("string").alias("sentimentScore"),
        ratings.agreement(F.col("overall"), label).alias("ratingSentimentAgreement"),
        *[c for c in ["arrived"] if c in rows.columns],
    )


def stream_review_table(spark, sf_dir):
    """The processed stream feeds both consumers; their columns meet when the table is read."""
    work = _work_dir(spark)
    lexicon, rules = valence_lexicon(spark), corpus_rules()
    words = bad_words(spark)

    def consume(batch, batch_id):
        rows = mod.deduplicated(batch)
        rs.write_changes(mod.moderate(rows, words), f"{work}/moderation", batch_id)
        rs.write_changes(_scored(rows, lexicon, rules), f"{work}/sentiment", batch_id)

    rs.run_available(rs.start_batches(_review_stream(spark, sf_dir), f"{work}/cp", consume))
    return rs.reviews_table(spark, f"{work}/moderation", f"{work}/sentiment").select(
        "reviewId", "userId", "profanityCheck", "sentiment", "ratingSentimentAgreement"
    )


def stream_joined_reviews(spark, sf_dir):
    """Two streams, each with a consumer and a log of its own, whose logs are joined as streams.

    A review's id tells its time of arrival: one a second, from FIRST_ARRIVAL on.
    """
    work = _work_dir(spark)
    lexicon, rules, words = valence_lexicon(spark), corpus_rules(), bad_words(spark)
    arrived = F.timestamp_seconds(FIRST_ARRIVAL + F.regexp_extract("reviewId", r"(\d+)$", 1).cast("long"))

    def moderate(batch, batch_id):
        rows = mod.deduplicated(batch)
        mod.moderate(rows, words).withColumn("arrived", arrived).write.mode("overwrite").parquet(f"{work}/moderation/{batch_id}")

    def score(batch, batch_id):
        rows = mod.deduplicated(batch).withColumn("arrived", arrived)
        _scored(rows, lexicon, rules).write.mode("overwrite").parquet(f"{work}/sentiment/{batch_id}")

    for name, consume in (("moderation", moderate), ("sentiment", score)):
        rs.run_available(rs.start_batches(_review_stream(spark, sf_dir), f"{work}/cp-{name}", consume))
    sides = [
        spark.readStream.schema(spark.read.parquet(f"{work}/{name}/*").schema).parquet(f"{work}/{name}/*")
        for name in ("moderation", "sentiment")
    ]
    rs.run_available(rs.start_append(rs.joined_reviews(*sides), f"{work}/joined", f"{work}/cp-joined"))
    return spark.read.parquet(f"{work}/joined").select(
        "reviewId", "userId", "profanityCheck", "sentiment", "ratingSentimentAgreement"
    )


def _envelopes(spark, sf_dir):
    """One announcement per page, in each of the accepted shapes."""
    record = F.struct(
        F.struct(
            F.struct(F.lit("pages").alias("name")).alias("bucket"),
            F.struct(F.url_encode("url").alias("key")).alias("object"),
        ).alias("s3")
    )
    shape = F.col("page_id") % 4
    envelope = (
        F.when(shape == 0, F.to_json(F.struct(F.array(record).alias("Records"))))
        .when(shape == 1, F.to_json(F.array(record, record)))
        .when(shape == 2, F.to_json(record))
        .otherwise(F.lit('{"Event":"s3:TestEvent"}'))
    )
    return table(spark, sf_dir, "pages").select("page_id", envelope.alias("envelope"))


def envelope_records_query(spark, sf_dir):
    return envelope_records(_envelopes(spark, sf_dir))


QUERIES = {
    "stream_moderation": stream_moderation,
    "stream_user_bans": stream_user_bans,
    "stream_ban_reports": stream_ban_reports,
    "stream_review_table": stream_review_table,
    "stream_joined_reviews": stream_joined_reviews,
    "envelope_records": envelope_records_query,
}

_BOTH = (
    BATCH_SQL["review_table"].rsplit("SELECT * FROM review_table", 1)[0]
    + """SELECT m.reviewId, m.userId, m.profanityCheck, l.sentiment, l.agrees AS ratingSentimentAgreement
         FROM moderated m JOIN labelled l USING (reviewId)"""
)

SQL = {
    "stream_moderation": BATCH_SQL["moderated_reviews"].replace(
        "SELECT * FROM moderated", "SELECT reviewId, userId, overall, profanityCheck FROM moderated"
    ),
    "stream_user_bans": BATCH_SQL["user_bans"],
    "stream_ban_reports": BATCH_SQL["banned_users"],
    "stream_review_table": _BOTH,
    "stream_joined_reviews": _BOTH,
    "envelope_records": """SELECT page_id, 'pages' AS bucket, url AS key
        FROM pages, unnest(CASE page_id % 4 WHEN 1 THEN [1, 2] WHEN 3 THEN []::INTEGER[] ELSE [1] END) t(i)""",
}
