"""Review moderation: identity, politeness, user bans, keyed upserts and the tally."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import ratings
from gleanery.functions.tokenize import merged_text
from gleanery.operators.profanity import censor, is_profane, profanity_pattern
from gleanery.sources.tables import ensure_checkpoint_dir

UNKNOWN_USER = "unknown-user"
PENDING = "pending"
DEFAULT_BAN_LIMIT = 3
BAN_LIMIT_KEY = "gleanery.moderation.banLimit"


def ban_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BAN_LIMIT_KEY, str(DEFAULT_BAN_LIMIT)))


@dataclass(frozen=True)
class Settings:
    """What a deployment may set: the names of its tables, and how many impolite reviews a user may write."""

    reviews_table: str = "reviews"
    users_table: str = "users"
    ban_limit: int = DEFAULT_BAN_LIMIT


REVIEWS_TABLE_KEY = "gleanery.moderation.reviewsTable"
USERS_TABLE_KEY = "gleanery.moderation.usersTable"


def settings(spark: SparkSession) -> Settings:
    """The session's settings; what is unset or blank falls back to the defaults."""

    def named(key: str, fallback: str) -> str:
        return (spark.conf.get(key, None) or "").strip() or fallback

    default = Settings()
    return Settings(
        named(REVIEWS_TABLE_KEY, default.reviews_table), named(USERS_TABLE_KEY, default.users_table), ban_limit(spark)
    )


def with_review_id(reviews: DataFrame, random_ids: bool = False) -> DataFrame:
    """The source id if there is one, otherwise a content hash, so that a retry gives the same id.

    An id the input already carries stays.
    """
    fallback = F.expr("uuid()") if random_ids else F.sha2(F.to_json(F.struct("*")), 256)
    assigned = F.coalesce(F.nullif(F.col("sourceId"), F.lit("")), fallback)
    if "reviewId" in reviews.columns:
        assigned = F.coalesce(F.col("reviewId"), assigned)
    return reviews.withColumn("reviewId", assigned)


def deduplicated(reviews: DataFrame, key: str = "reviewId") -> DataFrame:
    """One row per id, the same one whatever the order of arrival.

    The minimum is taken before the shuffle too, so many copies of one id stay cheap.
    """
    rest = [c for c in reviews.columns if c != key]
    return (
        reviews.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select(*[key if c == key else F.col("row")[c].alias(c) for c in reviews.columns])
    )


def moderate(
    reviews: DataFrame, lexicon: DataFrame, boundaries: bool = True, null_as: str = ""
) -> DataFrame:
    """Politeness columns of every review; needs `reviewId`."""
    text = merged_text(F.col("summary"), F.col("reviewText"), null_as)
    profane = is_profane(text, profanity_pattern(lexicon, boundaries))
    return reviews.select(
        "reviewId",
        F.coalesce("reviewerID", F.lit(UNKNOWN_USER)).alias("userId"),
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("reviewText", F.lit("")).alias("reviewText"),
        ratings.stored_rating(F.col("overall")).alias("overall"),
        ratings.politeness_label(profane).alias("profanityCheck"),
    )


def censored(reviews: DataFrame, lexicon: DataFrame, mark: str = "*", boundaries: bool = True) -> DataFrame:
    text = merged_text(F.col("summary"), F.col("reviewText"))
    return censor(reviews, text, lexicon, mark, boundaries).select(
        "reviewId", F.col("censored").alias("text")
    )


def _impolite() -> Column:
    return F.col("profanityCheck") == "impolite"


def user_bans(moderated: DataFrame, limit: int = DEFAULT_BAN_LIMIT) -> DataFrame:
    """Impolite reviews per user; banned once there are more than `limit`. Clean users count 0."""
    return (
        moderated.groupBy("userId")
        .agg(F.count_if(_impolite()).alias("impoliteCount"))
        .withColumn("banned", F.col("impoliteCount") > limit)
    )


def running_impolite(moderated: DataFrame, order: list[str], limit: int = DEFAULT_BAN_LIMIT) -> DataFrame:
    """Each user's impolite reviews up to the one that triggers the ban, numbered from 1.

    Nothing after that review changes the ban, so each task keeps at most limit + 1 rows
    per user before the shuffle, also for a user with most of the reviews.
    """
    by_time = Window.partitionBy("userId").orderBy(*order)
    return (
        moderated.where(_impolite())
        .withColumn("impoliteCount", F.row_number().over(by_time).cast("long"))
        .where(F.col("impoliteCount") <= limit + 1)
    )


def ban_events(moderated: DataFrame, order: list[str], limit: int = DEFAULT_BAN_LIMIT) -> DataFrame:
    """The review that gets each banned user banned."""
    return running_impolite(moderated, order, limit).where(F.col("impoliteCount") == limit + 1)


MODERATION_COLUMNS = ["userId", "summary", "reviewText", "overall", "profanityCheck"]
SENTIMENT_COLUMNS = ["sentiment", "sentimentScore", "ratingSentimentAgreement"]


def _side(table: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return table.select(
        F.col("reviewId"), F.lit(True).alias(f"{prefix}here"), *[F.col(c).alias(prefix + c) for c in columns]
    )


def upsert_moderation(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Write the moderation columns by id; the sentiment becomes pending only where it is absent."""
    old = stored.select("reviewId", *MODERATION_COLUMNS, *SENTIMENT_COLUMNS)
    new = _side(incoming, MODERATION_COLUMNS, "new_")
    fresh = F.col("new_here")
    return old.join(new, "reviewId", "full_outer").select(
        "reviewId",
        *[F.when(fresh, F.col("new_" + c)).otherwise(F.col(c)).alias(c) for c in MODERATION_COLUMNS],
        F.when(fresh, F.coalesce("sentiment", F.lit(PENDING))).otherwise(F.col("sentiment")).alias("sentiment"),
        *SENTIMENT_COLUMNS[1:],
    )


def upsert_sentiment(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Write the sentiment columns by id; the two upserts touch disjoint columns."""
    old = stored.select("reviewId", *MODERATION_COLUMNS, *SENTIMENT_COLUMNS)
    new = _side(incoming, SENTIMENT_COLUMNS, "new_")
    fresh = F.col("new_here")
    return old.join(new, "reviewId", "full_outer").select(
        "reviewId",
        *MODERATION_COLUMNS,
        *[F.when(fresh, F.col("new_" + c)).otherwise(F.col(c)).alias(c) for c in SENTIMENT_COLUMNS],
    )


def review_table(moderated: DataFrame, sentiments: DataFrame) -> DataFrame:
    """Both upserts into an empty table at once: one full outer join on the id."""
    return moderated.join(sentiments, "reviewId", "full_outer").select(
        "reviewId",
        *MODERATION_COLUMNS,
        F.coalesce("sentiment", F.lit(PENDING)).alias("sentiment"),
        *SENTIMENT_COLUMNS[1:],
    )


def sentiment_histogram(table: DataFrame) -> DataFrame:
    return table.groupBy(F.coalesce("sentiment", F.lit(PENDING)).alias("sentiment")).agg(
        F.count("*").alias("n_reviews")
    )


def tally(table: DataFrame) -> DataFrame:
    """All counts of the summary in one pass."""
    agrees = F.col("ratingSentimentAgreement")
    return table.agg(
        F.count("*").alias("totalReviews"),
        F.count_if(_impolite()).alias("profanityFailCount"),
        F.count(agrees).alias("ratingSentimentComparedCount"),
        F.count_if(~agrees).alias("ratingSentimentDisagreementCount"),
        F.count_if(F.coalesce("sentiment", F.lit(PENDING)) == PENDING).alias("pendingCount"),
    )


def distinct_users(table: DataFrame) -> DataFrame:
    return table.where("userId is not null and userId <> ''").select("userId").distinct()


def banned_users(table: DataFrame, users: DataFrame) -> DataFrame:
    """Banned users who wrote at least one of the reviews."""
    return distinct_users(table).join(users.where("banned"), "userId").select(
        "userId", F.coalesce("impoliteCount", F.lit(0)).alias("impoliteCount")
    )


def summary(table: DataFrame, users: DataFrame) -> DataFrame:
    """The whole summary as one row: counts, sentiment map, number of banned users.

    The banned users are a table of their own, `banned_users`: they grow with the corpus.
    """
    agrees = F.col("ratingSentimentAgreement")
    # Users and labels are counted together, so that the reviews are read once; all else follows from these few rows.
    ensure_checkpoint_dir(table.sparkSession)
    by_user = (
        table.groupBy("userId", F.coalesce("sentiment", F.lit(PENDING)).alias("sentiment"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(_impolite()).alias("n_impolite"),
            F.count(agrees).alias("n_compared"),
            F.count_if(~agrees).alias("n_apart"),
        )
        .checkpoint()
    )
    columns = {"n": "totalReviews", "n_impolite": "profanityFailCount", "n_compared": "ratingSentimentComparedCount", "n_apart": "ratingSentimentDisagreementCount"}
    by_label = by_user.groupBy("sentiment").agg(*[F.sum(c).alias(c) for c in columns])
    n_banned = banned_users(by_user, users).agg(F.count("*")).scalar()
    return by_label.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in columns.items()],
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("sentiment", F.col("n").alias("n_reviews"))))).alias("sentimentCounts"),
    ).select(
        "totalReviews",
        "sentimentCounts",
        "profanityFailCount",
        "ratingSentimentComparedCount",
        "ratingSentimentDisagreementCount",
        n_banned.alias("bannedUserCount"),
    )


def named_summary(spark: SparkSession) -> DataFrame:
    """The summary of the tables that the session's settings name."""
    names = settings(spark)
    return summary(spark.table(names.reviews_table), spark.table(names.users_table))


def is_complete(table: DataFrame, expected: int) -> Column:
    """True once every expected review is there and none is pending."""
    return (
        tally(table)
        .select((F.col("totalReviews") >= expected) & (F.col("pendingCount") == 0))
        .scalar()
    )


def with_id_prefix(table: DataFrame, prefix: str = "devset-") -> DataFrame:
    return table.where(F.col("reviewId").startswith(prefix))


def with_sequential_id(reviews: DataFrame, order: list[str], column: str = "sourceId") -> DataFrame:
    """Number the rows from 0 in the given order as devset-000000, devset-000001, …

    The sorted rows are checkpointed once; each row's number is its place in its partition
    plus the size of the partitions before, so no task sees more than its own share.
    """
    ensure_checkpoint_dir(reviews.sparkSession)
    ordered = reviews.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    placed = ordered.withColumn("_part", F.shiftright("_row", 33)).withColumn(
        "_place", F.col("_row").bitwiseAND((1 << 33) - 1)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    number = F.col("_start") + F.col("_place")
    return (
        placed.join(starts, "_part")
        .withColumn(column, F.format_string("devset-%06d", number))
        .drop("_row", "_part", "_place", "_start")
    )
