"""The corpus pipeline: five stages, each of which reads what the one before it has written.

Quality rules drop documents, near-duplicate detection keeps the first of each group, personal data gets surrogates,
sources are mixed to their weights (documents repeat as often as the mix takes them), and each document left is
tokenised and decoded again.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import byte_bpe, minhash_join, mixing, quality_rules, surrogates
from gleanery.llm.frames import documents
from gleanery.llm.queries import RANK_FILE, SURROGATE_KEY
from gleanery.sources.tables import shared_dir


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(docs, labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_join.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.replaced(docs, SURROGATE_KEY).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs, labels(spark, sf_dir))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    made = byte_bpe.verified(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    return made.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decodes_to_text")


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix),
    ("byte_bpe", tokens),
]

#: Signatures, keyed surrogates and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each writes Parquet into the shared folder, which the next one reads."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
