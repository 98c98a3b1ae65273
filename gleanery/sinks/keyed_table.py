"""A review table in buckets by id, where an upsert rewrites the buckets that it touches and no others.

Rows lie in `rows/version=V/bucket=B`, one folder for each upsert and bucket. When the rows of an upsert are written, its list of
buckets is published in `published/version=V`; a bucket's rows are those of its newest published version. An upsert that fails
before that leaves the table as it was, and one that is run again writes the same rows. Choose the number of
buckets so that one is worth rewriting: an upsert of few rows costs as many buckets, whatever the table's size.
The list of newest versions, one entry a bucket, is all that reaches the driver. One writer at a time.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.tables import ensure_checkpoint_dir

ROWS = (
    "reviewId string, userId string, summary string, reviewText string, overall decimal(3,1), profanityCheck string, "
    "sentiment string, sentimentScore string, ratingSentimentAgreement boolean"
)
PUBLISHED = "bucket int, version int"


def bucket_of(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def create(spark: SparkSession, root: str) -> None:
    spark.createDataFrame([], "bucket int").write.mode("errorifexists").parquet(f"{root}/published/version=0")


def versions(spark: SparkSession, root: str) -> dict[int, int]:
    """The newest version of each bucket that holds rows, by bucket."""
    listed = spark.read.schema(PUBLISHED).parquet(f"{root}/published")
    return {r.bucket: r.version for r in listed.groupBy("bucket").agg(F.max("version").alias("version")).collect()}


def read(spark: SparkSession, root: str, buckets: set[int] | None = None) -> DataFrame:
    """The table, or the rows of some of its buckets."""
    held = versions(spark, root)
    folders = [f"{root}/rows/version={v}/bucket={b}" for b, v in sorted(held.items()) if buckets is None or b in buckets]
    return spark.read.schema(ROWS).parquet(*folders) if folders else spark.createDataFrame([], ROWS)


def upsert(root: str, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], n_buckets: int) -> int:
    """Merge rows into their buckets by `merge(stored, incoming)`, an upsert by reviewId; returns the new version.

    `n_buckets` stays the same for all upserts of a table. Rows without an id are refused.
    """
    spark = incoming.sparkSession
    ensure_checkpoint_dir(spark)
    identified = F.when(F.col("reviewId").isNull(), F.raise_error(F.lit("a review without id"))).otherwise(F.col("reviewId"))
    rows = incoming.withColumn("reviewId", identified).checkpoint()
    touched = {r.bucket for r in rows.select(bucket_of(F.col("reviewId"), n_buckets).alias("bucket")).distinct().collect()}
    version = 1 + max(versions(spark, root).values(), default=0)
    if not touched:
        return version - 1
    merged = merge(read(spark, root, touched), rows).withColumn("bucket", bucket_of(F.col("reviewId"), n_buckets))
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/version={version}")
    listed = spark.createDataFrame([(b,) for b in sorted(touched)], "bucket int")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{root}/published/version={version}")
    return version
