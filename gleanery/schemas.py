"""Explicit schemas; no source infers its columns."""

from pyspark.sql import types as T

# `overall` is read as text so that a badly typed rating does not lose the review.
REVIEW = T.StructType([
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("reviewText", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("overall", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sourceId", T.StringType()),
    T.StructField("reviewId", T.StringType()),
])

ARRIVAL_RECORD = T.StructType([
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
    ])),
])

ARRIVAL_ENVELOPE = T.StructType(
    [
        T.StructField("Event", T.StringType()),
        T.StructField("Records", T.ArrayType(ARRIVAL_RECORD)),
    ]
    + ARRIVAL_RECORD.fields
)

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

VALENCE_LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("measure", T.DoubleType()),
])
