"""Small helpers over DataFrames that the operators of this package share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.sources.tables import ensure_checkpoint_dir

#: A word: a run of characters other than the space and 0x09-0x0D.
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept(df: DataFrame) -> DataFrame:
    """Compute a frame once, into the shared folder; later steps read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`, however often that uses it."""
    return F.transform(F.array(value), body)[0]


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows, and bytes of text: what task counts are derived from."""
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return n, size or 0


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """`df` in sorted parts, numbered in order by `_part`; written once, so that every later step sees the same parts."""
    return kept(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def ranked(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Add each row's place in the order of all rows, from 0 on; rows that tie in `order` are ranked arbitrarily.

    Only the rows' number in each part meets in one task, and rows are sorted within their part.
    """
    parts = ranged(df, *order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(starts, "_part").withColumn(name, F.col("_start") + inside - 1).drop("_part", "_start")
