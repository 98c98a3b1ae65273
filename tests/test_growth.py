"""Steps that once cost too much for each word: they keep their rows, and are no longer interpreted or run twice."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import distances
from gleanery.functions.tokenize import letter_words
from gleanery.operators import (
    bayes, collocations, contexts, frequent_grams, gram_matches, language_id, maxent, moderation, normalize, textpairs, trees, valence, word_blocks,
)
from gleanery.operators.row_items import item_places
from gleanery.plans import corpus, models, normal


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _texts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_letter_words_are_not_filtered_one_by_one(spark):
    found = _texts(spark, "2 Foo bar-foo", "", None, "42").select("doc_id", letter_words(F.col("text")).alias("ws"))
    assert "lambda" not in _plan(found)
    assert [r.ws for r in found.orderBy("doc_id").collect()] == [["foo", "bar", "foo"], [], [], []]


def test_item_places_group_each_row_by_itself(spark):
    rows = _texts(spark, "b a b", "a", "", None)
    found = item_places(rows, ["doc_id"], F.split("text", " "), "token")
    assert {(r.doc_id, r.token, tuple(r.places)) for r in found.collect()} == {
        (0, "a", (1,)), (0, "b", (0, 2)), (1, "a", (0,)), (2, "", (0,))
    }


def test_token_places_have_no_interpreted_grouping(spark):
    stop = spark.createDataFrame([("the",)], "word string")
    found = normalize.token_places(_texts(spark, "The cat, the 2 cats and a cat"), "doc_id", stop)
    assert "lambda" not in _plan(found)
    assert {(r.token, tuple(r.places)) for r in found.collect()} == {("cat", (1, 8)), ("cats", (5,)), ("and", (6,)), ("a", (7,))}


def test_tagged_words_know_the_word_before(spark, tmp_path):
    _texts(spark, "le chanted chanted le", "", None).write.parquet(f"{tmp_path}/documents.parquet")
    found = normal._tagged(spark, str(tmp_path))
    assert "lambda" not in _plan(found)
    assert [(r.pos, r.word, r.tag) for r in found.orderBy("pos").collect()] == [
        (0, "le", "JJ"), (1, "chanted", "NN"), (2, "chanted", "VB"), (3, "le", "JJ")
    ]


def test_trigrams_are_counted_within_their_text(spark):
    found = language_id.trigram_counts(_texts(spark, "aaa aaa b", None, "𐐨𐐨"), ["doc_id"])
    assert "lambda" not in _plan(language_id.ranked_trigrams(_texts(spark, "a"), "doc_id"))
    assert [tuple(r) for r in found.orderBy("doc_id", "place").collect()] == [
        (0, 0, "<aa", 2), (0, 1, "aa>", 2), (0, 2, "aaa", 2), (0, 3, "<b>", 1), (2, 0, "<𐐨𐐨", 1), (2, 1, "𐐨𐐨>", 1)
    ]


def test_contexts_come_from_slices(spark):
    found = contexts.word_contexts(_texts(spark, "a b", "", "c"), letter_words(F.col("text")))
    assert "lambda" not in _plan(found)
    assert {tuple(r) for r in found.collect()} == {("a", "*START*", "b", 1), ("b", "a", "*END*", 1), ("c", "*START*", "*END*", 1)}


def test_similar_words_go_through_the_texts_once(spark):
    found = contexts.word_contexts(_texts(spark, "x the y", "x a y"), letter_words(F.col("text")))
    assert _plan(contexts.similar_words(found, "the")).count("Generate") == 1
    assert _plan(contexts.word_similarity(found, "the")).count("Generate") == 1


def test_jaro_is_measured_once_a_pair(spark):
    pairs = spark.createDataFrame([("martha", "marhta"), ("dwayne", "duane"), ("a", "a"), ("", "x"), (None, "x")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    found = pairs.withColumn("j", distances.jaro_similarity(a, b)).withColumn("w", distances.jaro_winkler_similarity(a, b, jaro=F.col("j")))
    assert "lambda" not in _plan(found) and _plan(found).count("_jaro(") == 1
    assert [(r.j and round(r.j, 4), r.w and round(r.w, 4)) for r in found.collect()] == [
        (0.9444, 0.9611), (0.8222, 0.84), (0.0, 0.1), (0.0, 0.0), (None, None)
    ]


def test_presence_is_not_counted(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x", "b a b")], "doc_id int, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = models._presence(spark, str(tmp_path))
    assert "lambda" not in _plan(found)
    assert {tuple(r) for r in found.collect()} == {(1, "x", "a"), (1, "x", "b")}


def test_bayes_adds_whole_numbers(spark):
    terms = spark.createDataFrame([(1, "x", "a"), (2, "y", "b")], "k int, lang string, term string")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, lang string")
    found = bayes.classify(rows, terms, *bayes.train(terms, rows, "lang"), "k", "lang")
    assert "sum(_u" in _plan(found)
    assert {tuple(r) for r in found.collect()} == {(1, "x"), (2, "y"), (3, "x")}


def test_word_rows_are_slices(spark):
    rows = valence._word_rows(_texts(spark, "Ab BUT cd but", ""), "doc_id", F.col("text"))
    assert "transform" not in _plan(rows)
    assert [(r.doc_id, r.pos, r.w, r.p1, r.p2, r.p3, r.n1, r.n2, r.but_at, r.mixed_case) for r in rows.orderBy("doc_id", "pos").collect()] == [
        (0, 0, None, None, None, None, None, None, 2, True),
        (0, 1, "Ab", None, None, None, "BUT", "cd", 2, True),
        (0, 2, "BUT", "Ab", None, None, "cd", "but", 2, True),
        (0, 3, "cd", "BUT", "Ab", None, "but", None, 2, True),
        (0, 4, "but", "cd", "BUT", "Ab", None, None, 2, True),
        (1, 0, None, None, None, None, None, None, None, False),
    ]


def test_summary_reads_the_reviews_once(spark):
    rows = [("1", "u", "impolite", "positive", True), ("2", "u", "clean", None, False), ("3", None, "clean", "positive", None)]
    table = spark.createDataFrame(rows, "reviewId string, userId string, profanityCheck string, sentiment string, ratingSentimentAgreement boolean")
    users = spark.createDataFrame([("u", 4, True), ("v", 5, True)], "userId string, impoliteCount long, banned boolean")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    one = moderation.summary(table.mapInArrow(count, table.schema), users).collect()
    assert [tuple(r) for r in one] == [(3, {"pending": 1, "positive": 2}, 1, 2, 1, 1)] and seen.value == 3
    none = moderation.summary(table.where("false"), users).collect()
    assert [tuple(r) for r in none] == [(0, {}, 0, 0, 0, 0)]


def _plans_of_checkpoints(monkeypatch, spark):
    plans, kind = [], type(spark.range(0))
    plain = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *a: (plans.append(_plan(df)), plain(df, *a))[1])
    return plans


def test_terms_meet_their_document_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "ab"[i % 3 > 0]) for i in range(12)] + [(None, "a")], "doc_id int, lang string")
    found = [(i, t) for i in range(12) for t in (["x"] if i % 3 else ["y", "z"]) + [f"w{i % 2}"]]
    present = spark.createDataFrame(found, "doc_id int, term string")
    plans = _plans_of_checkpoints(monkeypatch, spark)
    tree = trees.grow(present, docs, "doc_id", "lang", 3, 1)
    assert sum(p.count("Join") for p in plans) == 1
    assert {(r.node, r.term, r.predicted, r.n, r.errors) for r in tree.collect()} == {
        (1, "x", "b", 13, 5), (2, None, "a", 5, 0), (3, None, "b", 8, 0)
    }
    grown = spark.createDataFrame(tree.collect(), tree.schema)
    named = trees.classify(grown, present, docs, "doc_id", 3)
    assert _plan(named).count("Join") == 1
    assert {(r.doc_id, r.predicted) for r in named.collect()} == {(i, "ab"[i % 3 > 0]) for i in range(12)}


def test_rows_of_one_key_share_their_terms(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "b")], "doc_id int, lang string")
    present = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "y")], "doc_id int, term string")
    tree = trees.grow(present, docs, "doc_id", "lang", 1, 1)
    assert {(r.node, r.n) for r in tree.collect() if r.node > 1 and r.predicted == "a"} <= {(2, 2), (3, 4)}
    got = trees.classify(tree, present, docs, "doc_id", 1)
    assert {(r.doc_id, r.predicted) for r in got.collect()} == {(1, "a"), (2, "b"), (3, "b")}


def _sides(spark, refs, hyps):
    return (
        spark.createDataFrame([(p, r, t.split()) for p, r, t in refs], "pair string, ref long, tokens array<string>"),
        spark.createDataFrame([(p, t.split()) for p, t in hyps], "pair string, tokens array<string>"),
    )


def test_grams_are_matched_where_a_pair_meets(spark):
    refs, hyps = _sides(
        spark,
        [("p", 1, "a b a"), ("p", 1, "a"), ("p", 2, "a b c"), ("p", None, "c c"), ("q", 1, ""), (None, 1, "a")],
        [("p", "a b a a"), ("p", "c"), ("q", "a"), (None, "a"), ("r", "a")],
    )
    found = gram_matches.match_counts(hyps, refs, 1, 3)
    assert "gram" not in _plan(found) and _plan(found).count("Generate") == 0
    assert {tuple(r) for r in found.collect()} == {
        ("p", 1, 1, 4), ("p", 1, 2, 2), ("p", 1, 3, 1), ("p", 2, 1, 3), ("p", 2, 2, 1), ("p", None, 1, 1)
    }
    best = gram_matches.match_counts(hyps, refs, 1, 3, best=True)
    assert {(r.pair, r.n, r.hit) for r in best.collect()} == {("p", 1, 5), ("p", 2, 2), ("p", 3, 1)}
    grams = gram_matches.matched_grams(hyps, refs, 2, 3).collect()
    assert {(r.ref, r.gram.replace(gram_matches.SEPARATOR, " "), r.hit) for r in grams} == {
        (1, "a b", 1), (1, "b a", 1), (1, "a b a", 1), (2, "a b", 1)
    }


def test_scores_explode_no_grams(spark):
    refs, hyps = _sides(spark, [("p", 1, "a b c d"), ("p", 2, "a b")], [("p", "a b c")])
    for score in (textpairs.bleu, textpairs.gleu):
        assert "concat_ws" not in _plan(score(refs, hyps))


def test_windows_give_the_frequency_of_every_order(spark):
    refs, _ = _sides(spark, [("p", 1, "a b c d a b c"), ("q", 1, "a b c"), (None, 1, "a b c e"), ("r", 1, "")], [])
    spelled = lambda text: text.replace(" ", gram_matches.SEPARATOR)
    wanted = spark.createDataFrame([(3, spelled("a b c")), (4, spelled("a b c d")), (3, spelled("x y z"))], "n int, gram string")
    found = textpairs._frequency(refs, wanted, 14, 5)
    assert {(r.n, r.gram.replace(gram_matches.SEPARATOR, " "), r.f) for r in found.collect()} == {
        (1, "a", 4), (1, "b", 4), (1, "c", 4), (1, "d", 1), (1, "e", 1), (3, "a b c", 4), (4, "a b c d", 1),
        (2, "a b", 4), (2, "b c", 4), (2, "c d", 1), (2, "d a", 1), (2, "c e", 1),
    }


@pytest.fixture(scope="module")
def babble(spark):
    """Texts of frequent and of rare words, of which some hold a rare word between frequent ones only."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("aabc") if rng.random() < 0.8 else "w" + "xyz"[rng.randrange(3)] * rng.randrange(1, 9) for _ in range(rng.randrange(40))) for _ in range(50)]
    return _texts(spark, *texts, "a a r a a", "a a r a a", "", None, "a", "q q q q q q").repartition(3)


def _same_grams(babble, made, n, window, least, monkeypatch):
    tokens = letter_words(F.col("text"))
    every = made(babble, tokens, window).where(F.col("count") >= least)
    for size, rows in ((1_000_000, 2_000_000), (60, 200)):
        monkeypatch.setattr(word_blocks, "TOKENS", size)
        monkeypatch.setattr(frequent_grams, "ROWS", rows)
        some = made(babble, tokens, window, min_count=least)
        assert some.dtypes == every.select(some.columns).dtypes and some.columns[: n + 2] == every.columns[: n + 2]
        found = {tuple(r) for r in some.collect()}
        assert found and found == {tuple(r) for r in every.select(some.columns).collect()}


def test_numbers_pass_for_bytes():
    import numpy as np

    for values in (np.array([], np.int32), np.array([-1, 0, 1 << 30], np.int32)):
        assert (word_blocks.unpacked(word_blocks.packed(values)) == values).all()
    assert (word_blocks.unpacked(word_blocks.packed(np.array([0.5, -1e300])), np.float64) == [0.5, -1e300]).all()


@pytest.mark.parametrize("window, least", [(4, 3), (6, 5)])
def test_frequent_quadgrams_are_counted_by_numbers(babble, monkeypatch, window, least):
    _same_grams(babble, collocations.quadgrams, 4, window, least, monkeypatch)


def test_no_words_leave_the_blocks_of_quadgrams(spark, tmp_path, monkeypatch):
    _texts(spark, *["a b c d e"] * 3, None).write.parquet(f"{tmp_path}/documents.parquet")
    plans = _plans_of_checkpoints(monkeypatch, spark)
    found = corpus.quadgram_collocations(spark, str(tmp_path))
    assert plans and not any("Aggregate [w1" in p for p in [*plans, _plan(found)])
    assert {(r.w1, r.w2, r.w3, r.w4, r["count"]) for r in found.collect()} == {("a", "b", "c", "d", 3), ("b", "c", "d", "e", 3)}


@pytest.mark.parametrize("window, least", [(4, 4), (5, 5)])
def test_a_word_may_be_rarer_than_its_triple(babble, monkeypatch, window, least):
    _same_grams(babble, collocations.trigrams, 3, window, least, monkeypatch)


def test_no_words_leave_the_blocks_of_triples_in_a_window(spark, tmp_path, monkeypatch):
    _texts(spark, *["a a r a a"] * 2, None).write.parquet(f"{tmp_path}/documents.parquet")
    plans = _plans_of_checkpoints(monkeypatch, spark)
    found = corpus.trigram_window(spark, str(tmp_path))
    assert plans and not any("Aggregate [w1" in p for p in [*plans, _plan(found)])
    assert ("a", "r", "a", 6) in {(r.w1, r.w2, r.w3, r["count"]) for r in found.collect()}


def test_no_words_leave_the_blocks_of_triples(spark, tmp_path, monkeypatch):
    _texts(spark, *["a b c d"] * 3, None).write.parquet(f"{tmp_path}/documents.parquet")
    plans = _plans_of_checkpoints(monkeypatch, spark)
    found = corpus.trigram_collocations(spark, str(tmp_path))
    assert plans and not any("Aggregate [w1" in p for p in [*plans, _plan(found)])
    assert {(r.w1, r.w2, r.w3, r["count"]) for r in found.collect()} == {("a", "b", "c", 3), ("b", "c", "d", 3)}


def _normal_models(spark):
    return {
        "tag_model": spark.createDataFrame([("Dogs", "NNS"), ("ran", "VBD")], "word string, tag string"),
        "lemma_table": spark.createDataFrame([("dog", "n"), ("run", "v")], "lemma string, pos string"),
        "exceptions": spark.createDataFrame([("ran", "v", "run")], "word string, pos string, lemma string"),
        "stop_words": spark.createDataFrame([("the",)], "word string"),
    }


@pytest.mark.parametrize("size", [1_000_000, 6])
def test_tokens_meet_their_forms_once_a_block(spark, monkeypatch, size):
    rows = [(1, "The dogs ran, the dog 4 ran"), (2, "Dogs dogs"), (2, "the ran ran"), (None, "dogs"), (3, None), (4, "The 4!")]
    docs = spark.createDataFrame(rows, "id int, text string").repartition(2)
    monkeypatch.setattr(word_blocks, "TOKENS", size)
    plans = _plans_of_checkpoints(monkeypatch, spark)
    found = normalize.normalized(docs, "id", **_normal_models(spark))
    # Neither what is written nor what is joined has a row for each token of a text.
    assert len(plans) == 1 and "Generate" not in plans[0] and "FlatMapCoGroupsInArrow" in _plan(found) and "array<array" not in _plan(found)
    assert sorted((r.id or 0, r.tokens) for r in found.collect()) == [
        (0, []), (1, ["dog", "run", "dog", "run"]), (2, ["dog", "dog", "run", "run"]), (2, ["dog", "dog", "run", "run"]), (3, []), (4, [])
    ]


def test_texts_of_different_keys_are_not_grouped(spark):
    docs = spark.createDataFrame([(1, "The dogs ran"), (None, "dogs"), (None, "ran"), (3, None)], "id int, text string")
    found = normalize.normalized(docs, "id", **_normal_models(spark))
    assert "collect_list" not in _plan(found)
    assert sorted((r.id or 0, r.tokens) for r in found.collect()) == [(0, []), (0, []), (1, ["dog", "run"]), (3, [])]


def test_words_are_counted_by_the_word_before(spark):
    packs = word_blocks.unstored(_texts(spark, "the a a", "the", "", None, "a the a b"), letter_words(F.col("text")))
    found = word_blocks.counts_after(packs, ["the"]).collect()
    assert {tuple(r) for r in found} == {("a", 4, 2, 2, 2, 2), ("the", 3, 0, 3, 0, 3), ("b", 1, 0, 1, 0, 1)}


@pytest.mark.parametrize("ids", [[1, 2, 3, 4], [1, 1, None, None], [1, 2, 2, None]])
def test_lemmas_are_known_without_a_row_for_each_word_of_a_text(spark, tmp_path, ids, monkeypatch):
    monkeypatch.setattr(normal, "MIN_LEMMA_DF", 2)
    texts = ["the chanted chanted le", "chanted the chanted simple", "le simple simple", "simple chanted"]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, tagged = normal._models(spark, str(tmp_path)), normal._tagged(spark, str(tmp_path))
    rows = {(r.doc_id, r.word, {"N": "n", "V": "v", "J": "a", "R": "r"}[r.tag[0]]) for r in tagged.collect()}
    wanted = {(w, p) for _, w, p in rows if sum((w, p) == (v, q) for _, v, q in rows) > 1}
    assert {tuple(r) for r in made["lemma_table"].collect()} == wanted
    assert {tuple(r) for r in made["tag_model"].collect()} == {tuple(r) for r in normal.tagging.train_unigram(tagged, cutoff=1).collect()}
    assert ("doc_id" in _plan(made["lemma_table"])) == (len(set(ids)) < 4)


def test_processed_reviews_move_no_row_for_each_token(spark, tmp_path, monkeypatch):
    rows = [(1, "s", "le", "Dogs ran\nfast"), (2, None, "le", None), (3, "s", "le", "dogs")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plans = _plans_of_checkpoints(monkeypatch, spark)
    found = normal.processed_reviews(spark, str(tmp_path))
    assert plans and not any("places" in p and "LeftAnti" in p for p in plans)
    assert [(r.reviewId, r.category, r.tokens) for r in found.orderBy("reviewId").collect()] == [
        ("devset-000001", "s", "dogs ran dogs ran fast"), ("devset-000002", None, ""), ("devset-000003", "s", "dogs dogs")
    ]


def test_streamed_reviews_are_written_compressed(spark, tmp_path, monkeypatch):
    rows = [(1, "Dogs ran\nfast", "le", "s", 13)] * 2 + [(2, None, "le", None, 0)]
    spark.createDataFrame(rows, normal.DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(normal, "shared_dir", lambda spark: str(tmp_path))
    found = normal.stream_processed_reviews(spark, str(tmp_path))
    written = [str(p) for p in tmp_path.glob("processed-*/processed/*/part-*")]
    assert written and all(p.endswith(".json.gz") for p in written)
    assert [(r.reviewId, r.category, r.overall, r.tokens) for r in found.orderBy("reviewId").collect()] == [
        ("devset-000001", "s", 2.0, "dogs ran dogs ran fast"), ("devset-000002", None, 3.0, "")
    ]


def test_a_round_moves_one_row_for_a_share_and_a_block(spark, monkeypatch):
    rows = [(i, "ab"[i % 3 > 0]) for i in range(30)] + [(3, "a"), (None, "a"), (40, None)]
    docs = spark.createDataFrame(rows, "doc_id int, lang string")
    found = [(i, c, t) for i, c in rows if i != 7 for t in (f"w{(i or 0) % 5}", f"v{(i or 0) % 7}", c, None)]
    present = spark.createDataFrame(found, "doc_id int, lang string, term string")
    whole = maxent.train(present, docs, "doc_id", "lang", 3)
    one = {(r.term, r.label): r.weight for r in whole.weights.collect()}
    guessed = sorted(maxent.classify(whole, present, docs, "doc_id").collect(), key=str)
    assert len(guessed) == 32 and {r.predicted for r in guessed if r.doc_id == 3} == {"a"}
    monkeypatch.setattr(maxent, "BLOCK", 30)
    monkeypatch.setattr(maxent, "LINKS", 9)
    plans = _plans_of_checkpoints(monkeypatch, spark)
    model = maxent.train(present, docs, "doc_id", "lang", 3)
    assert sum("FlatMapCoGroups" in p or "CoGroup" in p for p in plans[-3:]) == 3
    assert not any(word in p for p in plans[-3:] for word in ("Generate", "Join", "Aggregate"))
    assert {(r.term, r.label): r.weight for r in model.weights.collect()} == pytest.approx(one)
    assert sorted(maxent.classify(model, present, docs, "doc_id").collect(), key=str) == guessed
