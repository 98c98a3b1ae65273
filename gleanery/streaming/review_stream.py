"""The moderation dataflow as streams.  They call the same operators as the batch plans.

Stateful results are change logs in a shared folder: each micro-batch writes the rows it
changed into a directory named by its batch id, so a replayed batch overwrites its own
output, and the cost of a batch follows the batch and not the table.  The current table is
the newest row per key, put together when it is read.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators import moderation as mod

USER_CHANGES = "userId string, impoliteCount long, banned boolean, batch long"
MODERATION_CHANGES = (
    "reviewId string, userId string, summary string, reviewText string, overall decimal(3,1), "
    "profanityCheck string, batch long"
)
SENTIMENT_CHANGES = (
    "reviewId string, sentiment string, sentimentScore string, "
    "ratingSentimentAgreement boolean, batch long"
)


def run_available(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait until all input there is has been processed; False when the time ran out first."""
    if timeout is None:
        query.awaitTermination()
        return True
    done = bool(query.awaitTermination(timeout))
    if not done:
        query.stop()
    return done


def start_append(stream: DataFrame, out: str, checkpoint: str, format: str = "parquet") -> StreamingQuery:
    """Stateless projection to an append-only, exactly-once file sink."""
    return (
        stream.writeStream.format(format)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def start_batches(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_changes(rows: DataFrame, log: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")


def newest(spark: SparkSession, log: str, schema: str, key: str) -> DataFrame:
    """The last row of each key in a change log; reduced per task before the shuffle."""
    changes = spark.read.schema(schema).parquet(log)
    values = [c for c in changes.columns if c not in (key, "batch")]
    last = F.max(F.struct("batch", *values)).alias("last")
    return changes.groupBy(key).agg(last).select(key, *[F.col("last")[c].alias(c) for c in values])


def compact(spark: SparkSession, log: str, into: str, schema: str, key: str) -> None:
    """Write the newest row of each key of a change log as the first batch of another log.

    A stream goes on in the new log with its next batch, and reads stop growing with the history. Run it between
    batches; the old log is the caller's to remove.
    """
    last = spark.read.schema(schema).parquet(log).agg(F.max("batch")).scalar()
    rows = newest(spark, log, schema, key).withColumn("batch", F.coalesce(last, F.lit(0)))
    rows.write.mode("overwrite").partitionBy("batch").parquet(into)


def user_counts(
    moderated: DataFrame, limit: int, dedupe: bool = True, event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Keyed user state: impolite count and a ban that stays, since the count only grows.

    The state rows are an id and a number; texts are dropped before any shuffle.  With
    `dedupe` a redelivered review id counts once, otherwise each delivery counts. Ids are kept for ever
    unless `event_time` names a column by which they are dropped `delay` after the newest review.
    """
    marks = moderated.select("reviewId", "userId", "profanityCheck", *([event_time] if event_time else []))
    if dedupe and event_time:
        marks = marks.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["reviewId"])
    elif dedupe:
        marks = marks.dropDuplicates(["reviewId"])
    return mod.user_bans(marks, limit)


def start_user_counts(
    moderated: DataFrame, log: str, checkpoint: str, limit: int, dedupe: bool = True, **watermark: str
) -> StreamingQuery:
    """Every micro-batch logs the users whose count it changed."""
    counts = user_counts(moderated, limit, dedupe, **watermark)
    return start_batches(
        counts, checkpoint, lambda rows, batch_id: write_changes(rows, log, batch_id), "update"
    )


def users_table(spark: SparkSession, log: str) -> DataFrame:
    return newest(spark, log, USER_CHANGES, "userId")


def ban_reports(spark: SparkSession, log: str) -> DataFrame:
    """Each ban once, with the batch that brought it."""
    banned = spark.read.schema(USER_CHANGES).parquet(log).where("banned")
    return banned.groupBy("userId").agg(F.min("batch").alias("batch"))


def reviews_table(spark: SparkSession, moderation_log: str, sentiment_log: str) -> DataFrame:
    """Both consumers merged by review id; a review without a label yet is pending."""
    return mod.review_table(
        newest(spark, moderation_log, MODERATION_CHANGES, "reviewId"),
        newest(spark, sentiment_log, SENTIMENT_CHANGES, "reviewId"),
    )


def joined_reviews(moderated: DataFrame, scored: DataFrame, event_time: str = "arrived", delay: str = "1 hour") -> DataFrame:
    """Both consumers' streams as one: a row for each review, in full outer join on its id.

    The two sides may bring a review in any order, up to `delay` apart by `event_time`, which both carry. A pair is put out
    when its second side comes. A side whose partner is missing is kept as state until the watermark, `delay` behind the
    newest row of the slower stream, has passed all times at which the partner could come; it is then put out alone, as
    pending or without moderation. What comes later still is dropped, so state does not grow with the history.
    """
    left = moderated.select("reviewId", *mod.MODERATION_COLUMNS, F.col(event_time).alias("_m")).withWatermark("_m", delay)
    right = scored.select(F.col("reviewId").alias("_id"), *mod.SENTIMENT_COLUMNS, F.col(event_time).alias("_s")).withWatermark("_s", delay)
    near = f"reviewId = _id AND _s >= _m - INTERVAL {delay} AND _s <= _m + INTERVAL {delay}"
    return left.join(right, F.expr(near), "full_outer").select(
        F.coalesce("reviewId", "_id").alias("reviewId"),
        *mod.MODERATION_COLUMNS,
        F.coalesce("sentiment", F.lit(mod.PENDING)).alias("sentiment"),
        *mod.SENTIMENT_COLUMNS[1:],
        F.coalesce("_m", "_s").alias(event_time),
    )
