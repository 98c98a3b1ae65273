"""Naive Bayes over word presence, as count tables and a sum of logarithms."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: expected-likelihood smoothing adds one half to every count.
GAMMA = 0.5


def train(doc_terms: DataFrame, documents: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(label, log2 prior) and (term, label, log2 P(term present | label)).

    A term that some document lacks has two values, present and absent; each pair of term
    and label is listed, also those never seen together.
    """
    sizes = documents.groupBy(label).agg(F.count("*").alias("n"))
    n_all = documents.agg(F.count("*")).scalar()
    n_labels = sizes.agg(F.count("*")).scalar()
    priors = sizes.select(
        label, "n", F.log2((F.col("n") + GAMMA) / (n_all + n_labels * GAMMA)).alias("log_prior")
    )
    seen = doc_terms.groupBy("term", label).agg(F.count("*").alias("c"))
    by_term = seen.groupBy("term").agg(
        F.sum("c").alias("df"), F.map_from_entries(F.collect_list(F.struct(label, "c"))).alias("by_label")
    )
    labels = sizes.agg(F.collect_list(F.struct(label, "n"))).scalar()
    listed = by_term.withColumns({"labels": labels, "total": n_all}).select(
        "term", "df", "by_label", "total", F.inline("labels")
    )
    values = F.when(F.col("df") < F.col("total"), 2).otherwise(1)
    c = F.coalesce(F.element_at("by_label", F.col(label)), F.lit(0))
    likelihood = (c + GAMMA) / (F.col("n") + values * GAMMA)
    return priors.select(label, "log_prior"), listed.select("term", label, F.log2(likelihood).alias("log_p"))


def classify(
    documents: DataFrame, doc_terms: DataFrame, priors: DataFrame, likelihoods: DataFrame, key: str, label: str
) -> DataFrame:
    """The likeliest label of every document from its known terms, or from the priors alone; ties by label.

    Sums are of ten decimals, counted in units of the last one, so they do not depend on the order of the terms.
    """

    def units(log_p: str) -> Column:
        return (F.col(log_p).cast("decimal(18,10)") * F.lit(10**10).cast("decimal(11,0)")).cast("long")

    scores = (
        doc_terms.select(key, "term")
        .join(likelihoods.select("term", label, units("log_p").alias("_u")), "term")
        .groupBy(key, label)
        .agg(F.sum("_u").alias("s"))
        .join(priors.select(label, units("log_prior").alias("_prior")), label)
        .withColumn("score", F.col("s") + F.col("_prior"))
    )
    best = scores.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("_s"), label)).alias("best"))
    likeliest = priors.agg(F.min_by(label, F.struct(-F.col("log_prior"), F.col(label)))).scalar()
    return (
        documents.select(key)
        .join(best, key, "left")
        .select(key, F.coalesce(F.col(f"best.{label}"), likeliest).alias("predicted"))
    )


def informative(likelihoods: DataFrame, label: str, k: int) -> DataFrame:
    """Terms whose presence is likeliest under one label compared with another."""
    spread = likelihoods.groupBy("term").agg(
        (F.max("log_p") - F.min("log_p")).alias("spread"), F.max_by(label, F.struct("log_p", label)).alias("label")
    )
    return spread.orderBy(F.desc("spread"), F.asc("term")).limit(k)


def feature_terms(doc_terms: DataFrame, k: int) -> DataFrame:
    """The k terms found in most documents."""
    df = doc_terms.groupBy("term").agg(F.count("*").alias("df"))
    return df.orderBy(F.desc("df"), F.asc("term")).limit(k)
