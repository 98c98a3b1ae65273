"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled 1) and all documents of the corpus, unlabelled, are enough: documents labelled 0 are
never looked at. With the loss l(z) = log(1 + exp(-z)), a class prior p, positives P and unlabelled U, the risk of a
linear score g is

    p * mean_P l(g) + max(0, mean_U l(-g) - p * mean_P l(-g)),

the non-negative unbiased estimator of Kiryo et al. (2017). With this loss it is convex: it is the larger of two convex
functions, with and without the second part. Newton steps minimise the one with it. If the second part is negative
at that place, the sign of overfitting, the least risk lies where it is zero; it is found by weighing the second part by a
factor below 1, by bisection. A small ridge keeps the weights finite; as it and the factor draw the scores
together, the constant is set last so that the mean score of the unlabelled rows is the prior.

The prior is estimated, not given: a classifier of positives against unlabelled rows is fitted on one half of the rows and
counts on the other. Among its highest scores nearly all documents are good, so there the share of unlabelled rows, over that of
positives, is the prior; the least ratio over cutoffs that keep at least half of the positives is taken.

Features are those of `text_features`, computed once from whole texts and written (about 300 bytes a row). Every pass over
them sums gradients, curvatures and risks by task, then over tasks; only sums of a fixed size reach the driver, so the fit
uses all rows at any size. Rows whose id's checksum is divisible by `FOLDS` are held out: they take no part in the fit.

A null text counts as empty. A row without id is neither labelled nor held out. An id labelled more than once is positive if
no label says otherwise; rows with equal ids share the label. Without any positives, every score is 0.5; a table without rows
gives no rows.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.frames import kept
from gleanery.llm.hashing import text_column
from gleanery.llm.text_features import NAMES, features

FOLDS = 5
RIDGE = 0.01
CLIP = 8.0
CUTOFF = 0.3
PASSES = 20
BISECTIONS = 20
BINS = 2_000
WIDTH = len(NAMES) + 1  # and a constant


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(NAMES)).astype(float)


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -CLIP, CLIP)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def featured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, and the features `x` of each text."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = features(text_column(batch.column("text")))
            offsets = pa.array(np.arange(len(table) + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))], ["key", "x"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, x array<float>")


def prepared(docs: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """key, x, fold (of FOLDS; 0 is held out, null without an id) and positive; written once."""
    fold = F.crc32(F.col("key").cast("string").cast("binary")) % FOLDS
    trusted = (
        labels.groupBy(F.col(key).alias("label_key")).agg(F.min(quality).alias("good")).filter("good = 1 AND label_key IS NOT NULL")
    )
    rows = kept(featured(docs, key)).withColumn("fold", fold.cast("int"))
    joined = rows.join(trusted, (rows["key"] == trusted["label_key"]) & (rows["fold"] > 0), "left")
    return kept(joined.select("key", "x", "fold", F.col("label_key").isNotNull().alias("positive")))


def summed(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of `part` (features, fold, positive -> `size` numbers) over all rows, first in each task and then place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                fold = batch.column("fold").fill_null(-1).to_numpy()
                total += part(matrix(batch.column("x")), fold, batch.column("positive").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    sums = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    found = np.zeros(size)
    for place, value in sums.groupBy("place").agg(F.sum("value")).collect():
        found[place] = value
    return found


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean and deviation of the features, and the numbers of rows and of positives."""
    n = len(NAMES)

    def part(x, fold, positive):
        return np.concatenate([x.sum(0), (x * x).sum(0), [len(x), positive.sum()]])

    sums = summed(rows, part, 2 * n + 2)
    rows_n = max(sums[-2], 1)
    mean = sums[:n] / rows_n
    scale = np.sqrt(np.maximum(sums[n : 2 * n] / rows_n - mean**2, 0))
    return mean, np.where(scale < 1e-6, 1.0, scale), int(sums[-2]), int(sums[-1])


def ridge(strength: float = RIDGE) -> np.ndarray:
    """Strength of the penalty on each weight; the constant is all but free."""
    return np.append(np.full(WIDTH - 1, strength), 1e-6)


def _curved(z: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return ((z.T * weight) @ z).ravel()


def halves(fold: np.ndarray) -> np.ndarray:
    return fold % 2


def separators(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, steps: int = 7) -> np.ndarray:
    """For either half of the rows, weights of a logistic classifier of positives against unlabelled rows fitted on it."""
    weights, size = np.zeros((2, WIDTH)), 2 * WIDTH + 2 * WIDTH**2 + 2
    for _ in range(steps):

        def part(x, fold, positive, at=weights):
            z, found = standardised(x, mean, scale), []
            for half in (0, 1):
                u = z[halves(fold) == half]
                p = z[(halves(fold) == half) & positive]
                of_u, of_p = sigmoid(u @ at[half]), sigmoid(p @ at[half])
                found += [of_u @ u, -(1 - of_p) @ p, _curved(u, of_u * (1 - of_u)), _curved(p, of_p * (1 - of_p)), [len(u), len(p)]]
            return np.concatenate(found)

        sums = summed(rows, part, 2 * size)
        for half in (0, 1):
            s = sums[half * size : (half + 1) * size]
            n_u, n_p = max(s[-2], 1), max(s[-1], 1)
            slope = s[:WIDTH] / n_u + s[WIDTH : 2 * WIDTH] / n_p + ridge() * weights[half]
            curve = (s[2 * WIDTH : 2 * WIDTH + WIDTH**2] / n_u + s[2 * WIDTH + WIDTH**2 : -2] / n_p).reshape(WIDTH, WIDTH)
            weights[half] = weights[half] - np.linalg.solve(curve + np.diag(ridge()), slope)
    return weights


def binned(scores: np.ndarray) -> np.ndarray:
    """Bins of equal width over scores from -20 to 20."""
    return np.clip(((scores + 20) * (BINS / 40)).astype(int), 0, BINS - 1)


def class_prior(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, keeping: float = 0.5) -> float:
    """Share of good documents among all, from cutoffs that keep at least `keeping` of the positives."""
    weights = separators(rows, mean, scale)

    def part(x, fold, positive):
        z = standardised(x, mean, scale)
        scores = np.where(halves(fold) == 0, z @ weights[1], z @ weights[0])
        bins = binned(scores)
        return np.concatenate([np.bincount(bins, minlength=BINS), np.bincount(bins[positive], minlength=BINS)])

    sums = summed(rows, part, 2 * BINS)
    above = np.cumsum(sums.reshape(2, BINS)[:, ::-1], axis=1)
    shares = above / np.maximum(above[:, -1:], 1)
    enough = shares[1] >= keeping
    return float(np.clip((shares[0][enough] / shares[1][enough]).min(initial=1.0), 0.01, 0.99))


@dataclass
class Sums:
    """Risks, slopes and curvatures at some weights, as means over the unlabelled and the positive rows."""

    unlabelled_negative: float
    positive_positive: float
    positive_negative: float
    u_slope: np.ndarray
    p_slope: np.ndarray
    p_mean: np.ndarray
    u_curve: np.ndarray
    p_curve: np.ndarray

    def negative(self, prior: float) -> float:
        return self.unlabelled_negative - prior * self.positive_negative


def sums_at(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> Sums:
    def part(x, fold, positive):
        u = standardised(x, mean, scale)
        score = u @ weights
        p, of_u = u[positive], sigmoid(score)
        of_p = of_u[positive]
        risks = [loss(-score).sum(), loss(score[positive]).sum(), loss(-score[positive]).sum(), len(u), len(p)]
        curves = [_curved(u, of_u * (1 - of_u)), _curved(p, of_p * (1 - of_p))]
        return np.concatenate([of_u @ u, (1 - of_p) @ p, p.sum(0), *curves, risks])

    s = summed(rows, part, 3 * WIDTH + 2 * WIDTH**2 + 5)
    n_u, n_p = max(s[-2], 1), max(s[-1], 1)
    u_slope, p_slope, p_mean = s[: 3 * WIDTH].reshape(3, WIDTH)
    u_curve, p_curve = s[3 * WIDTH : -5].reshape(2, WIDTH, WIDTH)
    return Sums(s[-5] / n_u, s[-4] / n_p, s[-3] / n_p, u_slope / n_u, p_slope / n_p, p_mean / n_p, u_curve / n_u, p_curve / n_p)


def newton(
    rows: DataFrame, mean: np.ndarray, scale: np.ndarray, prior: float, share: float, weights: np.ndarray, at: Sums, passes: int
) -> tuple[np.ndarray, Sums]:
    """Weights (and their sums) of least risk with the second part times `share`; a step that raises it is halved."""

    def risk(w, s):
        return prior * s.positive_positive + share * s.negative(prior) + 0.5 * (ridge() * w**2).sum()

    def step(w, s):
        slope = share * s.u_slope - prior * ((1 - share) * s.p_slope + share * s.p_mean) + ridge() * w
        return np.linalg.solve(share * s.u_curve + prior * (1 - share) * s.p_curve + np.diag(ridge()), slope)

    move = step(weights, at)
    for _ in range(passes):
        tried = weights - move
        then = sums_at(rows, mean, scale, tried)
        gained = risk(weights, at) - risk(tried, then)
        if gained < 0:
            move = move / 2
            continue
        weights, at = tried, then
        if gained < 1e-8:
            break
        move = step(weights, at)
    return weights, at


def minimised(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk."""
    start = np.zeros(WIDTH)
    weights, at = newton(rows, mean, scale, prior, 1.0, start, sums_at(rows, mean, scale, start), PASSES)
    if at.negative(prior) >= 0:
        return weights
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS):
        share = (low + high) / 2
        weights, at = newton(rows, mean, scale, prior, share, weights, at, PASSES)
        if abs(at.negative(prior)) < 1e-4:
            break
        low, high = (low, share) if at.negative(prior) < 0 else (share, high)
    return weights


def shifted(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float) -> np.ndarray:
    """The weights with the constant at which the mean score is the prior, from counts of scores in bins."""

    def part(x, fold, positive):
        return np.bincount(binned(standardised(x, mean, scale) @ weights), minlength=BINS)

    counts = summed(rows, part, BINS)
    centres = (np.arange(BINS) + 0.5) * (40 / BINS) - 20
    low, high = -40.0, 40.0
    for _ in range(50):
        middle = (low + high) / 2
        under = counts @ sigmoid(centres + middle) < prior * counts.sum()
        low, high = (middle, high) if under else (low, middle)
    return weights + np.append(np.zeros(WIDTH - 1), (low + high) / 2)


def fit(rows: DataFrame) -> Model:
    """A model from all rows of `prepared` that are not held out."""
    learned = rows.filter("fold > 0 OR fold IS NULL")
    mean, scale, _, n_positive = moments(learned)
    if not n_positive:
        return Model(mean, scale, np.zeros(WIDTH), 0.5)
    prior = class_prior(learned, mean, scale)
    weights = minimised(learned, mean, scale, prior)
    return Model(mean, scale, shifted(learned, mean, scale, weights, prior), prior)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """key, held_out, and the score: the probability that the document is good."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sigmoid(standardised(matrix(batch.column("x")), model.mean, model.scale) @ model.weights)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), pa.array(scores)], ["key", "held_out", "score"])

    wanted = rows.select("key", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "x")
    return wanted.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, held_out boolean, score double")


def classified(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, held_out, score, predicted (1 from a score of CUTOFF on)."""
    rows = prepared(docs, labels, key)
    found = scored(rows, fit(rows))
    return found.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int")).withColumnRenamed("key", key)
