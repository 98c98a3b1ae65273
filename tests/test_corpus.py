import inspect
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanery.functions import distances, json_fields, stems
from gleanery.functions.tokenize import letter_words
from gleanery.operators import (
    agreement,
    bayes,
    classify,
    collocations,
    contexts,
    features,
    frequency,
    langmodel,
    language_id,
    ngrams,
    textpairs,
)
from gleanery.plans import registry


@pytest.fixture
def texts(spark):
    rng = random.Random(3)
    words = ["aa", "bb", "cc", "dd", "ee"]
    rows = [(i, [rng.choice(words) for _ in range(rng.randrange(0, 12))]) for i in range(40)]
    return spark.createDataFrame(rows, "id long, ws array<string>"), dict(rows)


def _dict(rows, *keys, value="n"):
    return {tuple(r[k] for k in keys): r[value] for r in rows.collect()}


def test_ngram_kinds(spark):
    row = spark.createDataFrame([("a b c d e".split(),)], "ws array<string>")
    ws = F.col("ws")
    assert [tuple(r) for r in ngrams.ngrams(row, ws, 3).collect()] == [("a", "b", "c"), ("b", "c", "d"), ("c", "d", "e")]
    assert [tuple(r) for r in ngrams.ngrams(row, ws, 2, left="<s>", right="</s>").collect()][::5] == [("<s>", "a"), ("e", "</s>")]
    assert ngrams.ngrams(row, ws, 6).count() == 0
    grams = {r.gram for r in ngrams.everygrams(row, ws, 1, 2).collect()}
    assert grams == {"a", "b", "c", "d", "e", "a b", "b c", "c d", "d e"}
    skips = [tuple(r) for r in ngrams.skipgrams(row, ws, 2, 2).collect()]
    assert sorted(skips) == sorted([("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("b", "e"), ("c", "d"), ("c", "e"), ("d", "e")])
    assert ngrams.skipgrams(row, ws, 3, 2).count() == 10


def test_bigram_counts_match_brute_force(texts):
    df, raw = texts
    for window in (2, 4):
        words, pairs = Counter(), Counter()
        for ws in raw.values():
            words.update(ws)
            for i in range(len(ws)):
                for w2 in ws[i + 1 : i + window]:
                    pairs[(ws[i], w2)] += 1
        got = collocations.bigrams(df, F.col("ws"), window).collect()
        assert {(r.w1, r.w2): r["count"] for r in got} == pairs
        for r in got:
            assert (r.n_ix, r.n_xi, r.n_xx) == (words[r.w1], words[r.w2], sum(words.values()))
            assert r.n_ii == pytest.approx(r["count"] / (window - 1))


def test_measures_by_hand(spark):
    one = spark.createDataFrame([("a", "b", 1, 1.0, 2, 73, 2000)], "w1 string, w2 string, count long, n_ii double, n_ix long, n_xi long, n_xx long")
    m = collocations.BigramMeasures()
    r = one.select(m.pmi().alias("pmi"), m.dice().alias("dice"), m.phi_sq().alias("phi"), m.chi_sq().alias("chi"),
                   m.student_t().alias("t"), m.likelihood_ratio().alias("llr"), m.jaccard().alias("j")).first()
    ii, ix, xi, xx = 1, 2, 73, 2000
    oi, io = xi - ii, ix - ii
    oo = xx - ii - oi - io
    phi = (ii * oo - io * oi) ** 2 / ((ii + io) * (ii + oi) * (io + oo) * (oi + oo))
    assert r.pmi == pytest.approx(math.log2(ii * xx) - math.log2(ix * xi))
    assert r.dice == pytest.approx(2 * ii / (ix + xi))
    assert (r.phi, r.chi) == (pytest.approx(phi), pytest.approx(phi * xx))
    assert r.t == pytest.approx((ii - ix * xi / xx) / math.sqrt(ii))
    assert r.j == pytest.approx(ii / (ii + oi + io))
    cells = [(ii, ix * xi / xx), (oi, (xx - ix) * xi / xx), (io, ix * (xx - xi) / xx), (oo, (xx - ix) * (xx - xi) / xx)]
    assert r.llr == pytest.approx(2 * sum(o * math.log(o / e + 1e-20) for o, e in cells if o))


def test_trigram_cells(spark):
    names = ["n_iii", "n_iix", "n_ixi", "n_xii", "n_ixx", "n_xix", "n_xxi", "n_xxx"]
    one = spark.createDataFrame([(1, 1, 1, 1, 1, 73, 1, 2000)], ", ".join(f"{n} long" for n in names))
    cells = collocations.Measures(3).cells()
    row = one.select(*[v.alias("".join("i" if j in k else "o" for j in range(3))) for k, v in cells.items()]).first().asDict()
    assert row == {"iii": 1, "iio": 0, "ioi": 0, "oii": 0, "ioo": 0, "oio": 72, "ooi": 0, "ooo": 1927}


def test_frequency_tables(spark):
    rows = spark.createDataFrame([(w,) for w in "a a a b b c d".split()], "term string")
    counts = frequency.counted(rows, "term")
    assert _dict(frequency.freq_dist(counts), "term", value="freq")[("a",)] == pytest.approx(3 / 7)
    assert sorted(r.term for r in frequency.hapaxes(counts).collect()) == ["c", "d"]
    assert _dict(frequency.count_of_counts(counts), "r", value="n_r") == {(1,): 2, (2,): 1, (3,): 1}
    assert [r.term for r in frequency.most_common(counts, "term", 3).collect()] == ["a", "b", "c"]
    p = counts.select("term", frequency.lidstone(counts, 0.5).alias("p"), frequency.witten_bell(counts).alias("w"))
    got = {r.term: (r.p, r.w) for r in p.collect()}
    assert got["a"] == (pytest.approx(3.5 / 9), pytest.approx(3 / 11))
    assert frequency.witten_bell_unseen(counts, 10).first().p == pytest.approx(4 / (6 * 11))


def test_good_turing_is_a_distribution(texts):
    df, raw = texts
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(1.0))}" for _ in range(2000)]
    counts = frequency.counted(df.sparkSession.createDataFrame([(w,) for w in words], "term string"), "term")
    table = frequency.good_turing(counts).collect()
    seen = sum(r.p * r.n_r for r in table)
    ones = sum(r.n_r for r in table if r.r == 1)
    assert seen == pytest.approx(1 - ones / 2000)


def test_contexts(texts, spark):
    df, raw = texts
    found = contexts.word_contexts(df, F.col("ws"))
    brute = Counter()
    for ws in raw.values():
        for i, w in enumerate(ws):
            brute[(w, ws[i - 1] if i else "*START*", ws[i + 1] if i + 1 < len(ws) else "*END*")] += 1
    assert _dict(found, "word", "left", "right") == brute
    own = {k[1:] for k in brute if k[0] == "aa"}
    shared = Counter(k[0] for k in brute if k[0] != "aa" and k[1:] in own)
    got = contexts.similar_words(found, "aa", 3).collect()
    assert [(r.word, r.n_shared) for r in got] == sorted(shared.items(), key=lambda x: (-x[1], x[0]))[:3]
    both = contexts.common_contexts(found, ["aa", "bb"]).collect()
    assert {(r.left, r.right) for r in both} == own & {k[1:] for k in brute if k[0] == "bb"}


def test_concordance(spark):
    row = spark.createDataFrame([(1, "x the cat sat on the mat".split())], "id long, ws array<string>")
    got = contexts.concordance(row, "id", F.col("ws"), ["the"], width=20).orderBy("offset").collect()
    assert [r.offset for r in got] == [1, 5]
    assert got[0].left_print == "      x" and got[0].right_print == "cat sat"
    assert got[1].left_print == " sat on"
    phrase = contexts.concordance(row, "id", F.col("ws"), ["the", "mat"]).collect()
    assert [r.offset for r in phrase] == [5]


def test_language_models_sum_to_one(spark):
    sents = [("a b c a".split(),), ("a b d".split(),), ("c a b".split(),)]
    df = spark.createDataFrame(sents, "ws array<string>")
    counts = langmodel.fit(df, F.col("ws"), 2, cutoff=2)
    known = sorted(r.word for r in counts.vocabulary.collect())
    assert known == ["</s>", "<s>", "a", "b", "c"]
    outcomes = known + ["<UNK>"]
    asked = spark.createDataFrame([(c, w, 1) for c in ["a", "b", "<UNK>", "zz"] for w in outcomes], "w1 string, w2 string, n long")
    scored = langmodel.score(asked, counts)
    sums = scored.groupBy("w1").agg(*[F.sum(m).alias(m) for m in ("mle", "laplace", "lidstone", "witten_bell", "absolute_discount", "kneser_ney")])
    for r in sums.collect():
        seen = r.w1 in ("a", "b", "<UNK>")
        assert r.mle == pytest.approx(1.0 if seen else 0.0)
        for m in ("laplace", "lidstone", "witten_bell", "absolute_discount"):
            assert r[m] == pytest.approx(1.0), (r.w1, m)
    a_b = scored.where("w1 = 'a' and w2 = 'b'").first()
    assert a_b.mle == pytest.approx(3 / 4) and a_b.laplace == pytest.approx(4 / 10)


def test_text_pair_scores(spark):
    ref = "the cat is on the mat".split()
    refs = spark.createDataFrame([("p", 1, ref), ("p", 2, "there is a cat on the mat".split())], "pair string, ref long, tokens array<string>")
    same = spark.createDataFrame([("p", ref)], "pair string, tokens array<string>")
    assert textpairs.bleu(refs, same).first().bleu == pytest.approx(1.0)
    assert textpairs.gleu(refs, same).first().gleu == pytest.approx(1.0)
    the = spark.createDataFrame([("p", ["the"] * 7)], "pair string, tokens array<string>")
    assert textpairs.bleu(refs, the, 1).first().bleu == pytest.approx(2 / 7)
    pairs = spark.createDataFrame([("p", "ab cd", "ab cd")], "pair string, reference string, hypothesis string")
    # Orders five and six do not fit into four letters.
    assert textpairs.chrf(pairs).first().chrf == pytest.approx(4 / 6)


def test_published_pair_scores(spark):
    """Values printed in the documentation of the usual implementations."""
    hyp1 = "It is a guide to action which ensures that the military always obeys the commands of the party".split()
    hyp2 = "he read the book because he was interested in world history".split()
    refs1 = [
        "It is a guide to action that ensures that the military will forever heed Party commands".split(),
        "It is the guiding principle which guarantees the military forces always being under the command of the Party".split(),
        "It is the practical guide for the army always to heed the directions of the party".split(),
    ]
    ref2 = "he was interested in world history because he read the book".split()
    refs = spark.createDataFrame([("1", i, r) for i, r in enumerate(refs1)] + [("2", 0, ref2)], "pair string, ref long, tokens array<string>")
    hyps = spark.createDataFrame([("1", hyp1), ("2", hyp2)], "pair string, tokens array<string>")
    assert textpairs.bleu(refs, hyps).first().bleu == pytest.approx(0.5920, abs=1e-4)
    assert textpairs.gleu(refs, hyps).first().gleu == pytest.approx(0.5673, abs=1e-4)
    one = hyps.where("pair = '1'"), refs.where("pair = '1'")
    assert textpairs.nist(one[1], one[0]).first().nist == pytest.approx(3.3709, abs=1e-4)


def test_agreement_known_case(spark):
    rng = random.Random(1)
    data = [(c, i, rng.choice("xyz")) for i in range(60) for c in ("c1", "c2", "c3")]
    ann = spark.createDataFrame(data, "coder string, item long, label string")
    got = agreement.coefficients(ann, ["c1", "c2", "c3"]).first()
    by = {(c, i): k for c, i, k in data}
    pairs = [("c1", "c2"), ("c1", "c3"), ("c2", "c3")]
    n = 60
    ao = {p: sum(by[p[0], i] == by[p[1], i] for i in range(n)) / n for p in pairs}
    share = {c: Counter(by[c, i] for i in range(n)) for c in ("c1", "c2", "c3")}
    ae = {p: sum(share[p[0]][k] * share[p[1]][k] for k in "xyz") / n**2 for p in pairs}
    avg = sum(ao.values()) / 3
    total = Counter(k for _, _, k in data)
    pi_e = sum(v * v for v in total.values()) / (n * 3) ** 2
    assert got.avg_ao == pytest.approx(avg)
    assert got.s == pytest.approx((avg - 1 / 3) / (1 - 1 / 3))
    assert got.pi == pytest.approx((avg - pi_e) / (1 - pi_e))
    assert got.kappa == pytest.approx(sum((ao[p] - ae[p]) / (1 - ae[p]) for p in pairs) / 3)
    assert got.multi_kappa == pytest.approx((avg - sum(ae.values()) / 3) / (1 - sum(ae.values()) / 3))
    def disagreement(c):
        m = sum(c.values())
        return (m * m - sum(v * v for v in c.values())) / (m * (m - 1))
    do = sum(3 * disagreement(Counter(by[c, i] for c in share)) for i in range(n)) / (3 * n)
    assert got.alpha == pytest.approx(1 - do / disagreement(total))


def test_rank_correlation(spark):
    a = spark.createDataFrame([("a", 9), ("b", 7), ("c", 7), ("d", 1)], "k string, n long")
    ranks = {r.k: r["rank"] for r in agreement.ranks(a, "k", "n").collect()}
    assert ranks == {"a": 0, "b": 1, "c": 1, "d": 3}
    up = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "k string, rank long")
    down = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "k string, rank long")
    assert agreement.spearman(up, up, "k").first().rho == 1.0
    assert agreement.spearman(up, down, "k").first().rho == -1.0


def test_weighted_f1_matches_the_ml_evaluator(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(float(rng.randrange(3)), float(rng.randrange(3))) for _ in range(200)], "label double, prediction double")
    ours = classify.weighted_f1(classify.confusion(rows)).first().f1
    assert ours == pytest.approx(classify.f1_evaluator().evaluate(rows))


def test_distances(spark):
    pairs = [("rain", "shine"), ("MARTHA", "MARHTA"), ("DIXON", "DICKSONX"), ("a", "a"), ("abc", "xyz"), ("JELLYFISH", "SMELLYFISH")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows.select(
        distances.edit_distance(a, b).alias("e"), distances.jaro_similarity(a, b).alias("j"),
        distances.jaro_winkler_similarity(a, b).alias("w"),
        distances.jaccard_distance(distances.letters(a), distances.letters(b)).alias("d"),
        distances.masi_distance(distances.letters(a), distances.letters(b)).alias("m"),
    ).orderBy("i").collect()
    assert got[0].e == 3
    assert [round(r.j, 3) for r in got] == [0.633, 0.944, 0.767, 0.0, 0.0, 0.896]
    assert [round(r.w, 3) for r in got[1:3]] == [0.961, 0.813]
    assert got[1].m == 0.0 and got[4].m == 1.0


def test_stems(spark):
    words = ["cars", "mass", "was", "bee", "compute", "advisable"]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.s for r in rows.select(stems.regexp_stem(F.col("w"), min_length=4).alias("s")).collect()]
    assert got == ["car", "mas", "was", "bee", "comput", "advis"]


def test_language_guess(spark):
    train = spark.createDataFrame([("the cat and the dog with the hat", "en"), ("der hund und die katze mit dem hut", "de")] * 3, "text string, lang string")
    profile = language_id.profiles(train)
    asked = spark.createDataFrame([(1, "the hat and the dog"), (2, "der hut und die katze")], "id long, text string")
    assert {r.id: r.guess for r in language_id.guess(asked, profile, "id").collect()} == {1: "en", 2: "de"}


def test_naive_bayes_by_hand(spark):
    docs = [(1, "x", "aa bb"), (2, "x", "aa"), (3, "y", "bb cc"), (4, "y", "cc")]
    rows = spark.createDataFrame(docs, "id long, label string, text string")
    terms = rows.select("id", "label", F.explode(F.split("text", " ")).alias("term"))
    priors, model = bayes.train(terms, rows, "label")
    p = {(r.term, r.label): 2**r.log_p for r in model.collect()}
    assert p[("aa", "x")] == pytest.approx(2.5 / 3) and p[("aa", "y")] == pytest.approx(0.5 / 3)
    assert p[("bb", "x")] == pytest.approx(1.5 / 3)
    asked = spark.createDataFrame([(9, "aa"), (9, "zz"), (8, "cc"), (8, "bb")], "id long, term string")
    got = {r.id: r.predicted for r in bayes.classify(asked.select("id").distinct(), asked, priors, model, "id", "label").collect()}
    assert got == {9: "x", 8: "y"}


def test_vocabulary_cut_and_ties(spark):
    docs = spark.createDataFrame([(1, "a a b b c".split()), (2, "a b c d".split()), (3, [])], "id long, ws array<string>")
    terms = features.document_terms(docs, ["id"], F.col("ws"))
    assert _dict(terms, "id", "term", value="tf")[(1, "a")] == 2
    full = features.vocabulary(terms).orderBy("index").collect()
    assert [(r["index"], r.term, r.df, r.tf) for r in full] == [(0, "a", 2, 3), (1, "b", 2, 3), (2, "c", 2, 2), (3, "d", 1, 1)]
    assert [r.term for r in features.vocabulary(terms, size=1).collect()] == ["a"]
    assert [r.term for r in features.vocabulary(terms, min_df=2).orderBy("index").collect()] == ["a", "b", "c"]


def test_feature_chi2_matches_the_ml_test(spark):
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.stat import ChiSquareTest

    rng = random.Random(4)
    docs = [(i, f"c{rng.randrange(3)}", [rng.choice("abcdefg") for _ in range(rng.randrange(1, 6))]) for i in range(90)]
    rows = spark.createDataFrame(docs, "id long, category string, ws array<string>")
    terms = features.document_terms(rows, ["id", "category"], F.col("ws"))
    sizes = rows.groupBy("category").agg(F.count("*").alias("n_c"))
    ours = features.feature_chi2(terms, sizes, rows.agg(F.count("*")).scalar(), sizes.agg(F.count("*")).scalar())
    got = {r.term: (r.chi2, r.dof) for r in ours.collect()}
    cv = CountVectorizerModel.from_vocabulary(list("abcdefg"), inputCol="ws", outputCol="f")
    labelled = cv.transform(rows).withColumn("label", F.substring("category", 2, 1).cast("double"))
    test = ChiSquareTest.test(labelled, "f", "label").first()
    for i, term in enumerate("abcdefg"):
        assert got[term] == (pytest.approx(test.statistics[i]), test.degreesOfFreedom[i])


def test_split_is_stable_and_near_its_weights(spark):
    rows = spark.range(5000).withColumn("split", classify.split_name(F.col("id")))
    shares = {r.split: r["count"] / 5000 for r in rows.groupBy("split").count().collect()}
    assert shares["train"] == pytest.approx(0.7, abs=0.03) and shares["test"] == pytest.approx(0.15, abs=0.02)
    again = spark.range(5000).repartition(5).withColumn("split", classify.split_name(F.col("id")))
    assert rows.join(again, ["id", "split"]).count() == 5000


def test_json_fields(spark):
    doc = '{"id": 1, "user": {"name": "n"}, "entities": {"tags": [{"text": "a", "pos": {"x": 1}}, {"text": "b"}]}}'
    rows = spark.createDataFrame([(doc,)], "doc string")
    assert tuple(json_fields.flat(rows, "doc", ["id", "user.name", "no.such"]).first()) == ("1", "n", None)
    got = json_fields.entities(rows, "doc", "entities.tags", ["text", "pos.x"]).collect()
    assert [tuple(r) for r in got] == [("a", "1"), ("b", None)]


def test_texts_without_known_trigrams_and_terms_keep_their_rows(spark):
    docs = spark.createDataFrame(
        [(1, "alpha beta", "b"), (2, "12 !!", "a"), (3, None, "b")], "doc_id long, text string, lang string"
    )
    profile = language_id.profiles(docs)
    assert {r.doc_id: r.guess for r in language_id.guess(docs, profile, "doc_id").collect()} == {1: "b", 2: "b", 3: "b"}
    terms = spark.createDataFrame([(1, "b", "alpha")], "doc_id long, lang string, term string")
    priors, likelihoods = bayes.train(terms, docs, "lang")
    got = bayes.classify(docs, terms, priors, likelihoods, "doc_id", "lang").collect()
    assert {r.doc_id: r.predicted for r in got} == {1: "b", 2: "b", 3: "b"}


def test_counts_of_every_condition(spark):
    rows = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), (None, "p")], "lang string, term string")
    got = {tuple(r) for r in frequency.tabulated(rows, "lang", "term").collect()}
    assert got == {("p", "x", 2), ("p", "y", 0), ("q", "x", 0), ("q", "y", 1)}


def test_registered_classifier_searches_the_full_grid(spark, monkeypatch):
    class Asked(Exception):
        pass

    def asked(*args, **kwargs):
        bound = inspect.signature(fit).bind(*args, **kwargs)
        bound.apply_defaults()
        raise Asked(bound.arguments["grid"], bound.arguments["folds"])

    fit = classify.fit_classifier
    monkeypatch.setattr(classify, "fit_classifier", asked)
    with pytest.raises(Asked) as found:
        registry.queries()["classifier_f1"](spark, "/root/testdata/sf0.001")
    grid, folds = found.value.args
    assert math.prod(len(values) for values in grid.values()) == 24 and folds == 3


def test_ranks_of_real_scores_over_many_parts(spark):
    rng = random.Random(5)
    scores = [(i, rng.choice([None, 0.5, float("-inf"), rng.random(), -rng.random()])) for i in range(400)]
    known = [s for _, s in scores if s is not None]
    expected = {i: sum(other > s for other in known) for i, s in scores if s is not None}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = agreement.ranks(spark.createDataFrame(scores, "k long, s double").repartition(7), "k", "s")
        assert {r.k: r["rank"] for r in found.collect()} == expected
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_every_marginal_is_counted_over_its_own_places(spark):
    docs = spark.createDataFrame([("a b c a b d a b c",), ("b a",), (None,)], "text string")
    for made, n in ((collocations.trigrams, 3), (collocations.quadgrams, 4)):
        grams = made(docs, letter_words(F.col("text")))
        plan = grams._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Aggregate \[" + ", ".join([r"w\d#\d+"] * n) + r"\]", plan)) == 1
    found = {(r.w1, r.w2, r.w3): r for r in collocations.trigrams(docs, letter_words(F.col("text")), 4).collect()}
    one = found["a", "b", "c"]
    # Four positions hold a; each counts once per choice of two later places among three.
    assert (one["count"], one.n_ixx, one.n_iix, one.n_ixi, one.n_xxx) == (2, 12, 6, 2, 33)
