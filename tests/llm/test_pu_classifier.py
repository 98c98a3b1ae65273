"""The quality classifier: features against plain counts, the prior, the risk, and held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import ODD, WORD
from pyspark.sql import functions as F

from gleanery.llm import pu_classifier, queries
from gleanery.llm.text_features import BYTE_CLASSES, CLASSES, NAMES, features

LARGER = "/root/testdata/sf0.01"


def plain(text):
    data = (text or "").encode()
    pairs = Counter(f"bytes_{BYTE_CLASSES[a]}{BYTE_CLASSES[b]}" for a, b in zip(data, data[1:]))
    found = {name: n / max(len(data) - 1, 1) for name, n in pairs.items()}
    words = WORD.findall(text or "")
    found["follows_itself"] = sum(a == b for a, b in zip(words, words[1:])) / max(len(words) - 1, 1)
    for k in (1, 2, 3):
        grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        found[f"again_{k}"] = (len(grams) - len(set(grams))) / max(len(grams), 1)
    lines = [x for x in data.split(b"\n") if x]
    found["again_lines"] = (len(lines) - len(set(lines))) / max(len(lines), 1)
    found["short_lines"] = sum(len(x) < 30 for x in lines) / max(len(lines), 1)
    found = {name: np.sqrt(v) for name, v in found.items()}
    found["log_words"] = np.log1p(len(words)) / 8
    found["log_word_bytes"] = np.log1p(len(data) / max(len(words), 1)) / 3
    return [found.get(name, 0) for name in NAMES]


def test_features(texts):
    assert len(NAMES) == CLASSES**2 + 8
    rows = [t for _, t in ODD] + ["a\nb\na\n\na", "ab ba\nba ab", "", "\n", "x x x", "x\n"] + [t for _, t in texts[:60]]
    got = features(pa.array(rows, pa.string()))
    np.testing.assert_allclose(got, np.array([plain(t) for t in rows]), atol=1e-6)
    np.testing.assert_array_equal(got[3:9], features(pa.array(rows, pa.string()).slice(3, 6)))
    assert features(pa.array([], pa.string())).shape == (0, len(NAMES))


@pytest.fixture(scope="module")
def mixture(spark):
    """Rows of two kinds whose features differ; 30 % are bad, and half of the good ones are trusted."""
    generator = np.random.default_rng(5)
    n = 6_000
    good = generator.random(n) < 0.7
    x = generator.random((n, len(NAMES))) * 0.2
    x[:, 0] += np.where(good, 0.5, 0.1) + generator.normal(0, 0.04, n)
    trusted = good & (generator.random(n) < 0.5)
    rows = [(i, x[i].tolist(), 1 + i % 4, bool(trusted[i])) for i in range(n)]
    return good, spark.createDataFrame(rows, "key long, x array<float>, fold int, positive boolean").cache()


def test_prior_and_scores_of_a_mixture(mixture):
    good, rows = mixture
    model = pu_classifier.fit(rows)
    assert abs(model.prior - 0.7) < 0.06
    scores = {r.key: r.score for r in pu_classifier.scored(rows, model).collect()}
    right = np.mean([(scores[i] >= 0.5) == good[i] for i in range(len(good))])
    assert right > 0.95


def test_weights_minimise_the_non_negative_risk(mixture):
    _, rows = mixture
    mean, scale, n, n_positive = pu_classifier.moments(rows)
    got = rows.orderBy("key").collect()
    x = np.array([r.x for r in got])
    positive = np.array([r.positive for r in got])
    np.testing.assert_allclose(mean, x.mean(0), atol=1e-9)
    np.testing.assert_allclose(scale, x.std(0), atol=1e-6)
    assert (n, n_positive) == (len(x), positive.sum())
    z = pu_classifier.standardised(x, mean, scale)

    def risk(w, prior):
        g = z @ w
        negative = pu_classifier.loss(-g).mean() - prior * pu_classifier.loss(-g[positive]).mean()
        penalty = 0.5 * (pu_classifier.ridge() * w**2).sum()
        return prior * pu_classifier.loss(g[positive]).mean() + max(negative, 0) + penalty, negative

    generator = np.random.default_rng(1)
    for prior, kinked in ((0.5, False), (0.8, True)):
        weights = pu_classifier.minimised(rows, mean, scale, prior)
        least, negative = risk(weights, prior)
        assert (abs(negative) < 1e-3) == kinked, (prior, negative)
        for width in (0.001, 0.01, 0.1):
            for _ in range(100):
                assert risk(weights + generator.normal(0, width, len(weights)), prior)[0] >= least - 1e-4


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")


def scores(docs, labels):
    return {r.doc_id: r for r in pu_classifier.classified(docs, labels).collect()}


@pytest.fixture(scope="module")
def base(tables):
    return scores(*tables)


def test_held_out_accuracy(tables, base):
    docs, labels = tables
    assert len(base) == docs.count()
    for r in base.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    pairs = [(base[r.doc_id].predicted, r.quality) for r in labels.collect() if base[r.doc_id].held_out]
    assert np.mean([p == q for p, q in pairs]) >= 0.95
    assert np.mean([p for p, q in pairs if q]) >= 0.95 and np.mean([not p for p, q in pairs if not q]) >= 0.8


def test_only_trusted_positives_of_the_learning_rows_count(tables, base):
    """Neither labels of held-out rows, nor labels 0, nor other columns change a score."""
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).filter("quality = 1")
    for i, r in scores(docs.select("doc_id", "text"), flipped).items():
        assert abs(r.score - base[i].score) < 1e-6


def test_odd_rows(odd, labels, empty):
    rows = pu_classifier.classified(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.doc_id is None and r.held_out]
    assert pu_classifier.classified(empty, labels).count() == 0
    assert {r.score for r in pu_classifier.classified(odd, labels.limit(0)).collect()} == {0.5}


def test_query(spark, sf_dir, texts):
    rows = queries.op13_pu_quality(spark, sf_dir)
    assert rows.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert sorted(r.doc_id for r in rows.collect()) == sorted(i for i, _ in texts)
