"""Parquet tables, and the review view over `documents`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables of texts, whose rows are worth far more work than their bytes suggest.
TEXT_KEYS = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"]}


#: Partitions that text tables are dealt into when they are read; unset, they keep the splits of their files.
PARTITIONS_KEY = "gleanery.input.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its files are split; a session whose text files can't be split asks for partitions instead."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wanted = spark.conf.get(PARTITIONS_KEY, None)
    return df.repartition(int(wanted), *TEXT_KEYS[name]) if wanted and name in TEXT_KEYS else df


def source_id(key: Column) -> Column:
    return F.format_string("devset-%06d", key)


def review_view(documents: DataFrame) -> DataFrame:
    """Read `documents` as product reviews: the source is the category, the first line the summary."""
    return documents.select(
        "doc_id",
        F.col("source").alias("category"),
        F.col("text").alias("reviewText"),
        F.substring_index("text", "\n", 1).alias("summary"),
        F.concat(F.lit("u"), (F.col("doc_id") % 37).cast("string")).alias("reviewerID"),
        (1 + F.col("doc_id") % 5).cast("double").alias("overall"),
        source_id(F.col("doc_id")).alias("sourceId"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_view(table(spark, sf_dir, "documents"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: spark.checkpoint.dir, or else one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
