"""Sinks: ranked terms, vocabulary, processed reviews, landing zone and summary."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ranked_lines(lines: DataFrame, path: str) -> None:
    """One file: a line per category and the dictionary line, in order."""
    lines.orderBy("part", "category").select("line").coalesce(1).write.mode("overwrite").text(path)


def write_vocabulary(terms: DataFrame, path: str) -> None:
    """One selected term per line, ascending; as long as the selection, never the corpus."""
    terms.select("term").orderBy("term").coalesce(1).write.mode("overwrite").text(path)


def write_counts(counts: DataFrame, path: str) -> None:
    counts.write.mode("overwrite").parquet(path)


def write_processed(reviews: DataFrame, path: str) -> None:
    """Processed reviews as JSON objects, many to a file."""
    reviews.write.mode("overwrite").json(path)


def write_landing_zone(reviews: DataFrame, path: str, files: int, limit: int | None = None) -> None:
    """Split reviews into `files` JSON files; the reading side sets the rate."""
    rows = reviews if not limit else reviews.orderBy("sourceId").limit(limit)
    rows.repartition(files, "sourceId").write.mode("overwrite").json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The one-row summary as one JSON document."""
    summary.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def show_report(summary: DataFrame) -> None:
    summary.show(truncate=False)


def show_sample(predictions: DataFrame, rows: int = 20) -> None:
    predictions.show(rows, truncate=80)
