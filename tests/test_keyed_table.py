"""Upserts into the table in buckets: what they write, and what they leave as it is."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gleanery.operators import moderation as mod
from gleanery.sinks import keyed_table

MODERATED = "reviewId string, userId string, summary string, reviewText string, overall decimal(3,1), profanityCheck string"
SCORED = "reviewId string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean"


def moderated(spark, ids, check="clean"):
    return spark.createDataFrame([(i, "u", "s", "t", None, check) for i in ids], MODERATED)


def scored(spark, ids):
    return spark.createDataFrame([(i, "positive", "0.5", True) for i in ids], SCORED)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_an_upsert_of_few_rows_leaves_other_buckets_as_they_are(spark, tmp_path):
    root, ids = f"{tmp_path}/reviews", [f"r{i}" for i in range(200)]
    keyed_table.create(spark, root)
    assert keyed_table.read(spark, root).count() == 0
    assert keyed_table.upsert(root, moderated(spark, ids), mod.upsert_moderation, 8) == 1
    before = files(root)
    assert keyed_table.versions(spark, root) == dict.fromkeys(range(8), 1)
    assert keyed_table.upsert(root, scored(spark, ["r3", "new"]), mod.upsert_sentiment, 8) == 2
    after = files(root)
    assert before.items() <= after.items()
    touched = {r.b for r in spark.createDataFrame([("r3",), ("new",)], "i string").select(keyed_table.bucket_of(F.col("i"), 8).alias("b")).collect()}
    written = {f.split("bucket=")[1].split("/")[0] for f in after.keys() - before.keys() if "bucket=" in f}
    assert written == {str(b) for b in touched} and len(touched) < 8
    assert {b for b, v in keyed_table.versions(spark, root).items() if v == 2} == touched
    rows = {r.reviewId: r for r in keyed_table.read(spark, root).collect()}
    assert len(rows) == 201 and rows["r3"].sentiment == "positive" and rows["r3"].profanityCheck == "clean"
    assert rows["r4"].sentiment == "pending" and rows["new"].userId is None


def test_upserts_agree_with_those_of_whole_tables(spark, tmp_path):
    root = f"{tmp_path}/reviews"
    keyed_table.create(spark, root)
    whole = spark.createDataFrame([], keyed_table.ROWS)
    steps = [
        (mod.upsert_sentiment, scored(spark, ["a", "b"])),
        (mod.upsert_moderation, moderated(spark, ["b", "c"])),
        (mod.upsert_moderation, moderated(spark, ["c", "d"], "impolite")),
        (mod.upsert_sentiment, scored(spark, ["d"])),
    ]
    for merge, rows in steps:
        keyed_table.upsert(root, rows, merge, 3)
        keyed_table.upsert(root, rows, merge, 3)  # run again
        whole = merge(whole, rows)
        got = keyed_table.read(spark, root).select(*whole.columns).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, whole.collect()))
    assert keyed_table.upsert(root, moderated(spark, []), mod.upsert_moderation, 3) == 8


def test_unpublished_rows_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/reviews"
    keyed_table.create(spark, root)
    keyed_table.upsert(root, moderated(spark, ["a"]), mod.upsert_moderation, 2)
    with pytest.raises(PySparkException):
        keyed_table.upsert(root, moderated(spark, [None]), mod.upsert_moderation, 2)
    broken = keyed_table.read(spark, root).withColumn("bucket", F.lit(0))
    broken.write.partitionBy("bucket").parquet(f"{root}/rows/version=2")
    assert [r.reviewId for r in keyed_table.read(spark, root).collect()] == ["a"]
    keyed_table.upsert(root, moderated(spark, ["b"]), mod.upsert_moderation, 2)
    assert sorted(r.reviewId for r in keyed_table.read(spark, root).collect()) == ["a", "b"]
