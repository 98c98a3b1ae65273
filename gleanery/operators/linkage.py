"""Average-link clustering: a bounded summary of the vectors, then exact linkage over it.

Pairwise distances of all vectors are out of reach, so vectors are first put into at most `size` micro-clusters, around vectors
chosen by a checksum of their ids and moved to their means a few times. A micro-cluster is known by its number of vectors,
their sum and the sum of their squares; these tell the mean squared distance over all pairs of vectors of two clusters exactly,
so average linkage over the micro-clusters is exact for them, however many vectors they hold. The summary, `size` times the
number of axes, and the merges over it are what the driver holds; every pass over the vectors is distributed.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.passes import totals


@dataclass
class Summary:
    """Micro-clusters: their centres, and the number, sum and sum of squares of their vectors."""

    centres: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    squares: np.ndarray


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centre nearest to each vector, distances rounded to nine digits; of equal ones the first."""
    gaps = np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)
    return np.round(gaps, 9).argmin(1)


def summarised(rows: DataFrame, size: int, key: str = "vec_id", column: str = "embedding", rounds: int = 2) -> Summary:
    """At most `size` micro-clusters of the vectors, all of which must have the same number of axes."""
    vectors = rows.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("x"))
    first = vectors.orderBy(F.md5(F.col("key").cast("string")), "key").limit(size).collect()
    if not first:
        return Summary(np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    centres = np.array([r.x for r in first])
    k, axes = centres.shape
    for left in range(rounds, -1, -1):

        def part(batch, centres=centres):
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
            own = np.zeros((len(x), k))
            own[np.arange(len(x)), nearest(x, centres)] = 1.0
            return [own.sum(0), (own.T @ x).ravel(), own.T @ (x * x).sum(1)]

        n, sums, squares = totals(vectors, part, [k, k * axes, k])
        sums = sums.reshape(k, axes)
        if left:
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return Summary(centres, n, sums, squares)


@dataclass(frozen=True)
class Merge:
    """Cluster `right` joins `left` (known by their first micro-clusters) at the mean squared distance `height`, to `n` vectors."""

    step: int
    left: int
    right: int
    height: float
    n: int


def linked(summary: Summary) -> list[Merge]:
    """The dendrogram over the micro-clusters that hold a vector; of equal heights (to nine digits) the first pair merges."""
    alive = [i for i in range(len(summary.n)) if summary.n[i] > 0]
    if not alive:
        return []
    n = summary.n[alive]
    spread, means = summary.squares[alive] / n, summary.sums[alive] / n[:, None]
    gaps = spread[:, None] + spread[None, :] - 2 * means @ means.T
    np.fill_diagonal(gaps, np.inf)
    merges = []
    for step in range(len(alive) - 1):
        a, b = divmod(int(np.round(gaps, 9).argmin()), len(alive))
        merged = (n[a] * gaps[a] + n[b] * gaps[b]) / (n[a] + n[b])
        n[a] += n[b]
        merges.append(Merge(step, alive[a], alive[b], float(gaps[a, b]), int(n[a])))
        merged[[a, b]] = np.inf
        gaps[a], gaps[:, a] = merged, merged
        gaps[b], gaps[:, b] = np.inf, np.inf
    return merges


def cut(summary: Summary, merges: list[Merge], k: int) -> np.ndarray:
    """The cluster of each micro-cluster when merging stops at `k` clusters."""
    cluster = np.arange(len(summary.n))
    for m in merges[: max(len(merges) + 1 - k, 0)]:
        cluster[cluster == m.right] = m.left
    return cluster


def assign(rows: DataFrame, summary: Summary, clusters: np.ndarray, column: str = "embedding") -> DataFrame:
    """Add `prediction`: the cluster of the vector's micro-cluster."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(column).flatten().to_numpy().astype(float).reshape(len(batch), -1)
            guess = clusters[nearest(x, summary.centres)] if len(batch) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(guess.astype(np.int32))], [*batch.schema.names, "prediction"])

    return rows.mapInArrow(run, f"{kind}, prediction int")
