"""Registered queries: the reviews as JSON files, written into the shared folder and read back by each reader."""

import uuid

from pyspark.sql import functions as F

from gleanery.operators import moderation as mod
from gleanery.plans.inputs import REVIEWS_CTE, bad_words, sql_profane
from gleanery.plans.moderation import MERGED_SQL
from gleanery.sources import arrivals, json_lines
from gleanery.sources.tables import reviews, shared_dir
from gleanery.streaming import review_stream as rs

FIELDS = ["reviewerID", "reviewText", "summary", "overall", "category", "sourceId"]
ARRAY_LENGTH = 1000


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"


def _lines(spark, sf_dir, broken: bool):
    """One JSON object per review; with `broken`, each is followed by a line that lacks its end."""
    json = F.to_json(F.struct(*FIELDS))
    rows = reviews(spark, sf_dir).select(json.alias("value"))
    cut = F.expr("left(value, length(value) - 1)")
    return rows.select(F.explode(F.array("value", cut)).alias("value")) if broken else rows


def _written(spark, sf_dir, broken: bool) -> str:
    folder = _folder(spark)
    _lines(spark, sf_dir, broken).write.text(folder)
    return folder


def _plain(rows):
    return rows.select("sourceId", "category", "reviewText", F.col("overall").cast("double").alias("overall"))


def json_tolerant(spark, sf_dir):
    """Broken lines are skipped."""
    return _plain(json_lines.read_reviews(spark, _written(spark, sf_dir, True), "tolerant"))


def json_strict(spark, sf_dir):
    """Any broken line would fail the job; there is none."""
    return _plain(json_lines.read_reviews(spark, _written(spark, sf_dir, False), "strict"))


def json_permissive(spark, sf_dir):
    """Broken lines become rows of nulls, which `labelled_text` removes."""
    rows = json_lines.read_reviews(spark, _written(spark, sf_dir, True), "permissive")
    return json_lines.labelled_text(rows)


def json_rejects(spark, sf_dir):
    """How many lines were taken and how many rejected, and from which categories the taken ones are."""
    lines = json_lines.read_reviews_with_rejects(spark, _written(spark, sf_dir, True))
    return lines.groupBy("rejected", F.col("review.category").alias("category")).agg(F.count("*").alias("n"))


def json_arrays(spark, sf_dir):
    """Files that hold one array of reviews each, at most ARRAY_LENGTH of neighbouring ids."""
    folder = _folder(spark)
    rows = reviews(spark, sf_dir).withColumn("part", (F.col("doc_id") / ARRAY_LENGTH).cast("long"))
    arrays = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*FIELDS))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return _plain(json_lines.read_reviews(spark, folder, multi_line=True))


def stream_json_reviews(spark, sf_dir):
    """Arriving JSON reviews, tested for bad words, to an append sink."""
    landing, work = _written(spark, sf_dir, False), _folder(spark)
    arriving = mod.with_review_id(arrivals.stream_reviews(spark, landing))
    rs.run_available(rs.start_append(mod.moderate(arriving, bad_words(spark)), f"{work}/out", f"{work}/cp"))
    return spark.read.parquet(f"{work}/out").select("reviewId", "userId", "profanityCheck")


QUERIES = {
    f.__name__: f
    for f in (json_tolerant, json_strict, json_permissive, json_rejects, json_arrays, stream_json_reviews)
}

_PLAIN = f"WITH {REVIEWS_CTE} SELECT sourceId, category, reviewText, overall FROM reviews"

SQL = {
    "json_tolerant": _PLAIN,
    "json_strict": _PLAIN,
    "json_permissive": f"WITH {REVIEWS_CTE} SELECT category, reviewText FROM reviews",
    "json_rejects": f"""WITH {REVIEWS_CTE} SELECT false AS rejected, category, count(*) AS n FROM reviews GROUP BY category
        UNION ALL SELECT true, NULL, count(*) FROM reviews""",
    "json_arrays": _PLAIN,
    "stream_json_reviews": f"""WITH {REVIEWS_CTE} SELECT sourceId AS reviewId, coalesce(reviewerID, 'unknown-user') AS userId,
        CASE WHEN {sql_profane(MERGED_SQL)} THEN 'impolite' ELSE 'clean' END AS profanityCheck FROM reviews""",
}
