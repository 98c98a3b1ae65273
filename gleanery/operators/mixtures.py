"""Gaussian mixtures with diagonal covariances, by expectation and maximisation.

Responsibilities are taken in logarithms, so that far vectors keep theirs. One pass a round adds up, for each component,
the responsibilities and the vectors and squares weighed by them; only these sums, 1 + 2 * axes numbers a component, reach the driver.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.passes import totals


@dataclass
class Mixture:
    shares: np.ndarray
    means: np.ndarray
    spreads: np.ndarray


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(len(batch), -1)


def log_densities(x: np.ndarray, model: Mixture) -> np.ndarray:
    """Logarithm of share times density, up to a constant, for each vector and component."""
    inverse = 1 / model.spreads
    squares = (x * x) @ inverse.T - 2 * x @ (model.means * inverse).T + (model.means**2 * inverse).sum(1)
    with np.errstate(divide="ignore"):
        return np.log(model.shares) - 0.5 * (squares + np.log(model.spreads).sum(1))


def responsibilities(x: np.ndarray, model: Mixture) -> np.ndarray:
    logs = log_densities(x, model)
    shares = np.exp(logs - logs.max(1, keepdims=True))
    return shares / shares.sum(1, keepdims=True)


def fit(rows: DataFrame, k: int, key: str = "vec_id", column: str = "embedding", rounds: int = 10, least_spread: float = 0.01) -> Mixture:
    """A mixture of `k` components; it starts from the vectors whose ids have the smallest checksums.

    A variance is at least `least_spread` of the axis's variance over all vectors. A component that loses all its vectors
    keeps its place, with no share. Vectors are taken as they are; all must have the same number of axes.
    """
    vectors = rows.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("x"))
    first = vectors.orderBy(F.md5(F.col("key").cast("string")), "key").limit(k).collect()
    if not first:
        return Mixture(np.zeros(0), np.zeros((0, 0)), np.zeros((0, 0)))
    means = np.array([r.x for r in first])
    k, axes = means.shape

    def moments(batch):
        x = _vectors(batch)
        return [x.sum(0), (x * x).sum(0), np.array([float(len(x))])]

    sums, squares, (n,) = totals(vectors, moments, [axes, axes, 1])
    overall = np.maximum(squares / n - (sums / n) ** 2, 1e-12)
    model = Mixture(np.full(k, 1 / k), means, np.tile(overall, (k, 1)))
    for _ in range(rounds):

        def part(batch, model=model):
            x = _vectors(batch)
            shares = responsibilities(x, model)
            return [shares.sum(0), (shares.T @ x).ravel(), (shares.T @ (x * x)).ravel()]

        weight, sums, squares = totals(vectors, part, [k, k * axes, k * axes])
        held = np.where(weight > 0, weight, 1.0)[:, None]
        means = np.where(weight[:, None] > 0, sums.reshape(k, axes) / held, model.means)
        spreads = np.where(weight[:, None] > 0, squares.reshape(k, axes) / held - means**2, model.spreads)
        model = Mixture(weight / n, means, np.maximum(spreads, least_spread * overall))
    return model


def assign(rows: DataFrame, model: Mixture, column: str = "embedding") -> DataFrame:
    """Add `prediction`: the component of the highest responsibility (of equal ones the first)."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(column).flatten().to_numpy().astype(float).reshape(len(batch), -1)
            guess = log_densities(x, model).argmax(1).astype(np.int32) if len(batch) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(guess)], [*batch.schema.names, "prediction"])

    return rows.mapInArrow(run, f"{kind}, prediction int")
