"""Clusterings as Spark ML fits."""

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def fit_clusters(rows: DataFrame, method: str, k: int, seed: int = 42):
    """k-means, or top-down bisection."""
    model = {
        "kmeans": KMeans(k=k, seed=seed, maxIter=30),
        "hierarchical": BisectingKMeans(k=k, seed=seed, maxIter=30),
    }[method]
    return model.fit(rows)
