"""Review files: JSON lines, JSON arrays and single objects."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.schemas import REVIEW


def read_reviews(spark: SparkSession, path: str, mode: str = "tolerant", multi_line: bool = False) -> DataFrame:
    """Reviews with the fixed schema.

    tolerant   broken lines are skipped
    strict     a broken line fails the job
    permissive a broken line becomes a row of nulls, for `dropna` to remove
    `multi_line` reads files that hold one array or one object instead of one object per line.
    """
    spark_mode = {"tolerant": "DROPMALFORMED", "strict": "FAILFAST", "permissive": "PERMISSIVE"}[mode]
    return (
        spark.read.schema(REVIEW)
        .option("mode", spark_mode)
        .option("multiLine", multi_line)
        .json(path)
    )


def read_reviews_with_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its parsed review, and `rejected` set where the line is no JSON object."""
    lines = spark.read.text(path)
    parsed = F.from_json("value", REVIEW, {"mode": "PERMISSIVE"})
    is_object = F.coalesce(F.expr("try_parse_json(value) IS NOT NULL"), F.lit(False)) & F.col(
        "value"
    ).rlike(r"^\s*\{")
    return lines.select(
        "value",
        F.when(is_object, parsed).alias("review"),
        (~is_object).alias("rejected"),
    )


def labelled_text(reviews: DataFrame) -> DataFrame:
    """Category and text of the rows that have both; an empty category stays."""
    return reviews.select("category", "reviewText").dropna()
