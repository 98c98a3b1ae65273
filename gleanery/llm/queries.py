"""The registered queries of this package, and the SQL they are checked against."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    anchors,
    byte_bpe,
    chat,
    hilbert,
    merkle,
    minhash_join,
    mixing,
    order_minhash,
    periodic_runs,
    pu_classifier,
    quality_rules,
    secret_scan,
    surrogates,
)
from gleanery.llm.frames import documents
from gleanery.llm.oracles import SQL

#: The key of the surrogates that the queries make; anyone else's is a secret of theirs.
SURROGATE_KEY = b"key of the test tables"
__all__ = ["QUERIES", "SQL"]

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tokens = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = byte_bpe.decode(tokens, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return chat.parsed(chat.conversations(chat.linear(rows.union(extra)))).select(
        F.col("tree").alias("conv_id"),
        "n_turns",
        digest("turns").alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        digest("loss_text").alias("loss_sha256"),
        F.col("n_chars").alias("formatted_chars"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sized(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mixed(rows).select("doc_id", "size", "source_size", "target", "taken")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.replaced(docs, SURROGATE_KEY)


def op5_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = anchors.without_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(documents(spark, sf_dir))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compared(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir)).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.sharded(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def id_crc32() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(documents(spark, sf_dir), seed=id_crc32())
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.*",
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda r: F.concat(r, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.leaves(documents(spark, sf_dir), tampered=id_crc32() % 3 == 0)
    columns = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return merkle.audited(rows).select(F.col("key").alias("doc_id"), *columns)


def op13_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.classified(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_chat": op2_chat,
    "op3_mixing": op3_mixing,
    "op4_surrogates": op4_surrogates,
    "op5_anchors": op5_anchors,
    "op6_minhash_join": op6_minhash_join,
    "op7_order_minhash": op7_order_minhash,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_hilbert": op10_hilbert,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle": op12_merkle,
    "op13_pu_quality": op13_pu_quality,
}
