"""Arriving reviews: streaming file sources, and the envelopes that announce objects."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.schemas import ARRIVAL_ENVELOPE, ARRIVAL_RECORD, REVIEW


def stream_reviews(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    """Each new file of the landing folder holds one or more JSON reviews."""
    return (
        spark.readStream.schema(REVIEW)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(landing)
    )


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def object_key(key: Column) -> Column:
    """Percent-escapes and plus signs decoded."""
    return F.url_decode(key)


def envelope_records(envelopes: DataFrame, column: str = "envelope") -> DataFrame:
    """Bucket and key of every record announced.

    An envelope is a list of records, an object with `Records`, one bare record, or a test
    event that announces nothing.  Anything else is an error.
    """
    text = F.col(column)
    as_list = F.from_json(text, T.ArrayType(ARRIVAL_RECORD))
    as_object = F.from_json(text, ARRIVAL_ENVELOPE)
    is_list = text.rlike(r"^\s*\[")
    none = F.array().cast(T.ArrayType(ARRIVAL_RECORD))
    unexpected = F.raise_error(F.concat(F.lit("unexpected event shape: "), text))
    records = (
        F.when(is_list, as_list)
        .when(as_object["Event"] == "s3:TestEvent", none)
        .when(as_object["Records"].isNotNull(), as_object["Records"])
        .when(as_object["s3"].isNotNull(), F.array(F.struct(as_object["s3"].alias("s3"))))
        .otherwise(unexpected.cast(T.ArrayType(ARRIVAL_RECORD)))
    )
    others = [c for c in envelopes.columns if c != column]
    return envelopes.select(*others, F.explode(records).alias("record")).select(
        *others,
        F.col("record.s3.bucket.name").alias("bucket"),
        object_key(F.col("record.s3.object.key")).alias("key"),
    )
