"""Word lists and lexicons; all are files or tables of the user's, none is bundled."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _required(path: str | None, what: str) -> str:
    if not path:
        raise ValueError(f"a {what} is needed; pass its path")
    return path


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, lower-cased, without blanks and doubles."""
    lines = spark.read.text(_required(path, "stop-word list"))
    return lines.select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def read_bad_words(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, case kept; each line is a pattern."""
    lines = spark.read.text(_required(path, "bad-word list"))
    return lines.select(F.trim("value").alias("word")).where("word <> ''")


def read_valence_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """The first two tab-separated fields of each line: word and measure."""
    lines = spark.read.text(_required(path, "valence lexicon"))
    fields = F.split(F.trim("value"), "\t")
    return lines.where("trim(value) <> ''").select(
        fields[0].alias("word"), fields[1].cast("double").alias("measure")
    )
