"""Maximum entropy, trees and mixtures against plain versions on small tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.operators import linkage, maxent, mixtures, trees


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        label = "abc"[i % 3]
        terms = {f"t{rng.randrange(15)}" for _ in range(rng.randrange(5))} | ({f"{label}{rng.randrange(3)}"} if rng.random() < 0.7 else set())
        rows.append((i, label, sorted(terms)))
    rows.append((120, "a", []))
    docs = spark.createDataFrame([(i, c) for i, c, _ in rows], "doc_id long, lang string")
    present = spark.createDataFrame([(i, c, t) for i, c, ts in rows for t in ts], "doc_id long, lang string, term string")
    return rows, docs, present


def plain_maxent(rows, rounds):
    labels = sorted({c for _, c, _ in rows})
    seen = Counter((t, c) for _, c, ts in rows for t in ts)
    filled = max(len(ts) for *_, ts in rows)
    weights, correction = dict.fromkeys(seen, 0.0), 0.0
    seen_filling = sum(filled - len(ts) for *_, ts in rows)

    def scores(ts):
        known = {c: [weights[t, c] for t in ts if (t, c) in weights] for c in labels}
        return {c: sum(w) + (filled - len(w)) * correction for c, w in known.items()}, {c: len(w) for c, w in known.items()}

    for _ in range(rounds):
        expected, filling = defaultdict(float), 0.0
        for _, _, ts in rows:
            s, n = scores(ts)
            total = sum(math.exp(v) for v in s.values())
            for c in labels:
                p = math.exp(s[c]) / total
                filling += p * (filled - n[c])
                for t in ts:
                    if (t, c) in weights:
                        expected[t, c] += p
        weights = {f: w + math.log(seen[f] / expected[f]) / filled for f, w in weights.items()}
        correction += math.log(seen_filling / filling) / filled
    return weights, correction, {i: min(labels, key=lambda c: (-round(scores(ts)[0][c], 9), c)) for i, _, ts in rows}


def test_maxent(corpus):
    rows, docs, present = corpus
    model = maxent.train(present, docs, "doc_id", "lang", 5)
    weights, correction, guesses = plain_maxent(rows, 5)
    got = {(r.term, r.label): r.weight for r in model.weights.collect()}
    assert got.keys() == weights.keys() and model.correction == pytest.approx(correction)
    for f, w in weights.items():
        assert got[f] == pytest.approx(w)
    assert {r.doc_id: r.predicted for r in maxent.classify(model, present, docs, "doc_id").collect()} == guesses
    unseen = docs.sparkSession.createDataFrame([(1, "new")], "doc_id long, term string")
    one = docs.where("doc_id = 1")
    assert maxent.classify(model, unseen, one, "doc_id").first().predicted == "a"


def test_maxent_without_terms(corpus):
    _, docs, present = corpus
    model = maxent.train(present.limit(0), docs, "doc_id", "lang", 2)
    assert {r.predicted for r in maxent.classify(model, present, docs, "doc_id").collect()} == {"a"}


def test_maxent_over_blocks_of_documents(corpus, monkeypatch):
    rows, docs, present = corpus
    one = {(r.term, r.label): r.weight for r in maxent.train(present, docs, "doc_id", "lang", 3).weights.collect()}
    monkeypatch.setattr(maxent, "BLOCK", 40)
    terms, keys = present.select(F.col("doc_id").alias("key"), "term"), docs.select(F.col("doc_id").alias("key"))
    packed = maxent._packed(terms, keys, present.count()).collect()
    assert len(packed) > 3 and sum(len(r.places) for r in packed) == present.count()
    many = {(r.term, r.label): r.weight for r in maxent.train(present, docs, "doc_id", "lang", 3).weights.collect()}
    assert many == pytest.approx(one)


def plain_tree(rows, depth, support, node=1, level=0):
    counts = Counter(c for _, c, _ in rows)
    predicted = min(counts, key=lambda c: (-counts[c], c))
    errors = len(rows) - counts[predicted]
    wrong = lambda part: len(part) - max(Counter(c for _, c, _ in part).values(), default=0)
    best = None
    if level < depth and len(rows) > support and errors:
        for t in sorted({t for *_, ts in rows for t in ts}):
            left = wrong([r for r in rows if t in r[2]]) + wrong([r for r in rows if t not in r[2]])
            if left < errors and (best is None or left < best[0]):
                best = (left, t)
    found = {node: (best and best[1], predicted, len(rows), errors)}
    if best:
        for has in (0, 1):
            part = [r for r in rows if (best[1] in r[2]) == bool(has)]
            if part:
                found |= plain_tree(part, depth, support, 2 * node + has, level + 1)
    return found


@pytest.mark.parametrize(("depth", "support"), [(3, 10), (5, 2)])
def test_tree(corpus, depth, support):
    rows, docs, present = corpus
    tree = trees.grow(present, docs, "doc_id", "lang", depth, support)
    expected = plain_tree(rows, depth, support)
    assert {r.node: (r.term, r.predicted, r.n, r.errors) for r in tree.collect()} == expected

    def walked(ts, node=1):
        term = expected[node][0]
        return expected[node][1] if term is None else walked(ts, 2 * node + (term in ts))

    got = trees.classify(tree, present, docs, "doc_id", depth).collect()
    assert {r.doc_id: r.predicted for r in got} == {i: walked(ts) for i, _, ts in rows}


def test_mixture_finds_its_parts_and_assigns_by_its_parameters(spark):
    generator = np.random.default_rng(2)
    centres = generator.normal(0, 4, (3, 6))
    x = np.concatenate([c + generator.normal(0, [0.3, 1, 0.5, 1, 0.2, 1], (60, 6)) for c in centres])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    model = mixtures.fit(rows, 3, rounds=25)
    assert model.shares.sum() == pytest.approx(1)
    got = np.array([r.prediction for r in mixtures.assign(rows, model).orderBy("vec_id").collect()])
    plain = [
        max(range(3), key=lambda c: math.log(model.shares[c]) - 0.5 * sum((v - model.means[c]) ** 2 / model.spreads[c] + np.log(model.spreads[c])))
        for v in x
    ]
    assert got.tolist() == plain
    for part in range(3):
        assert np.bincount(got[60 * part : 60 * part + 60]).max() >= 58
    for c in range(3):
        mine = x[got == c]
        np.testing.assert_allclose(model.means[c], mine.mean(0), atol=0.2)


def test_mixture_of_few_vectors(spark):
    rows = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    model = mixtures.fit(rows, 5, rounds=3)
    assert len(model.shares) == 2 and np.isfinite(model.means).all() and (model.spreads > 0).all()
    assert mixtures.fit(rows.limit(0), 5).means.size == 0


def plain_linkage(x):
    """Merges of average linkage over squared distances, from all pairs of vectors."""
    clusters, merges = {i: [i] for i in range(len(x))}, []
    while len(clusters) > 1:
        gap = {
            (a, b): round(float(np.mean([((x[i] - x[j]) ** 2).sum() for i in clusters[a] for j in clusters[b]])), 9)
            for a in clusters for b in clusters if a < b
        }
        a, b = min(gap, key=lambda p: (gap[p], p))
        clusters[a] += clusters.pop(b)
        merges.append((a, b, gap[a, b], len(clusters[a])))
    return merges


def test_average_linkage_is_exact_over_single_vectors(spark):
    generator = np.random.default_rng(7)
    x = generator.normal(0, 1, (24, 4)).round(3)
    x[5] = x[9]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    summary = linkage.summarised(rows, 100, rounds=0)
    order = [int(np.flatnonzero((x == c).all(1))[0]) for c in summary.centres]
    assert summary.n.sum() == 24 and sorted(summary.n) == [0.0] + [1.0] * 22 + [2.0]
    alive = [i for i in range(24) if summary.n[i] > 0]
    got = linkage.linked(summary)
    doubled = np.concatenate([[x[order[i]]] * int(summary.n[i]) for i in alive])
    plain = plain_linkage(doubled)
    assert [m.height for m in got] == pytest.approx([h for _, _, h, _ in plain if h > 0], abs=1e-8)
    assert [m.n for m in got] == [n for _, _, h, n in plain if h > 0]


def test_linkage_over_micro_clusters_and_its_cut(spark):
    generator = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0]])
    x = np.concatenate([c + generator.normal(0, 0.5, (50, 3)) for c in centres])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    summary = linkage.summarised(rows, 12)
    own = linkage.nearest(x, summary.centres)
    for c in range(12):
        np.testing.assert_allclose(summary.sums[c], x[own == c].sum(0), atol=1e-9)
    merges = linkage.linked(summary)
    for m in merges[:1]:
        pairs = [((a - b) ** 2).sum() for a in x[own == m.left] for b in x[own == m.right]]
        assert m.height == pytest.approx(np.mean(pairs))
    clusters = linkage.cut(summary, merges, 3)
    got = np.array([r.prediction for r in linkage.assign(rows, summary, clusters).orderBy("vec_id").collect()])
    assert all(len(set(got[50 * i : 50 * i + 50])) == 1 for i in range(3)) and len(set(got)) == 3
    assert linkage.cut(summary, merges, 100).tolist() == list(range(12))
    empty = linkage.summarised(rows.limit(0), 5)
    assert linkage.linked(empty) == [] and linkage.cut(empty, [], 3).size == 0
