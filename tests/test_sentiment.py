import pytest
from pyspark.sql import functions as F

from gleanery.functions import ratings
from gleanery.operators import opinion, valence


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(
        [("good", 1.9), ("bad", -2.5), ("shit", -2.6), ("wonderful", 2.7), ("loved", 2.9), ("terrible", -2.1),
         ("awful", -2.0), ("worst", -3.1), ("waste", -1.8)],
        "word string, measure double",
    )


def _compound(spark, lexicon, texts, **kw):
    rows = spark.createDataFrame([(f"{i:03d}", t) for i, t in enumerate(texts)], "reviewId string, text string")
    done = valence.polarity_scores(rows, lexicon, **kw).orderBy("reviewId").collect()
    return [r.compound for r in done]


FIXTURES = {
    "good": 0.4404,
    "not good": -0.3412,
    "very good": 0.4927,
    "not very good": -0.3865,
    "VERY good": 0.6028,
    "good!!!": 0.5826,
    "good but bad": -0.5859,
    "good not good": 0.7003,
    "": 0.0,
}


def test_fixtures(spark, lexicon):
    assert _compound(spark, lexicon, FIXTURES) == list(FIXTURES.values())
    assert _compound(spark, lexicon, ["good not good"], first_context=False) == [0.1265]


def _value(s, n_ep=0):
    return round(s / (s * s + 15) ** 0.5, 4)


def test_rules_worked_by_hand(spark, lexicon):
    cases = {
        "least good": _value(1.9 * -0.74),
        "at least good": _value(1.9),
        "very least good": _value(1.9 + 0.293 * 0.95),
        "never so good": _value((1.9 + 0.293) * 1.5),
        "kind of good": _value(1.9),
        "it was kind of good": _value(1.9 - 0.293),
        "this is the shit": _value(3.0),
        "so it good": _value(1.9 + 0.293 * 0.95),
        "GOOD it is": _value(1.9 + 0.733),
        "good?? maybe": _value(1.9 + 0.36),
        "good ??? ?": _value(1.9 + 0.96),
        "good???? maybe": 0.0,
        "bad!": _value(-2.5 - 0.292),
        "isn't good": _value(1.9 * -0.74),
        "good bad": _value(1.9 - 2.5),
    }
    assert _compound(spark, lexicon, cases) == list(cases.values())


def test_shares(spark, lexicon):
    rows = spark.createDataFrame([("a", "good but bad"), ("b", "plain text here")], "reviewId string, text string")
    a, b = valence.polarity_scores(rows, lexicon).orderBy("reviewId").collect()
    total = (1.9 * 0.5 + 1) + (2.5 * 1.5 + 1) + 1
    assert (a.neg, a.neu, a.pos) == (round(4.75 / total, 3), round(1 / total, 3), round(1.95 / total, 3))
    assert (b.neg, b.neu, b.pos, b.compound) == (0.0, 1.0, 0.0, 0.0)


def test_word_stripping(spark):
    row = spark.createDataFrame([("a good!! 'bad' x?!? (nice) :word, ?!?!odd don't",)], "t string")
    got = row.select(valence.words(F.col("t")).alias("w")).first().w
    # One listed mark, at one end only, and only from words of two letters or more.
    assert got == ["good", "'bad'", "x?!?", "(nice)", ":word,", "odd", "don't"]


def test_moderation_examples(spark, lexicon):
    cases = [
        ("Great purchase This product is absolutely wonderful, I loved it.", 5, "positive", True),
        ("Worst purchase ever Terrible, broken, awful experience, complete waste.", 5, "negative", False),
        ("Bad This is a damn awful product, total waste of money.", 1, "negative", True),
    ]
    rows = spark.createDataFrame([(str(i), c[0], c[1]) for i, c in enumerate(cases)], "reviewId string, text string, overall int")
    label = ratings.sentiment_label(F.col("compound"))
    got = (
        valence.polarity_scores(rows, lexicon).join(rows, "reviewId").orderBy("reviewId")
        .select(label.alias("l"), ratings.agreement(F.col("overall"), label).alias("a")).collect()
    )
    assert [(r.l, r.a) for r in got] == [(c[2], c[3]) for c in cases]


def test_negation_marks(spark):
    def marks(text, **kw):
        row = spark.createDataFrame([(text.split(),)], "t array<string>")
        return row.select(opinion.mark_negation(F.col("t"), **kw).alias("m")).first().m

    assert marks("I didn't like this movie . It was bad .") == [
        "I", "didn't", "like_NEG", "this_NEG", "movie_NEG", ".", "It", "was", "bad", "."]
    assert marks("not a not b . c") == ["not", "a_NEG", "not_NEG", "b_NEG", ".", "c"]
    assert marks("not a not b not c", double_flip=True) == ["not", "a_NEG", "not", "b", "not", "c_NEG"]
    assert marks("not . ! x never y") == ["not", ".", "!", "x", "never", "y_NEG"]
    assert marks("plain words") == ["plain", "words"]


def test_polarity_vote_keeps_texts_without_hits(spark, lexicon):
    rows = spark.createDataFrame([(1, "Good good bad"), (2, "bad"), (3, "nothing here"), (4, None)], "id long, text string")
    got = {r.id: r.polarity for r in opinion.polarity_vote(rows, lexicon, "id").collect()}
    assert got == {1: "positive", 2: "negative", 3: "neutral", 4: "neutral"}


def test_presence(spark):
    rows = spark.createDataFrame([(1, "ice is melting due to global warming")], "id long, text string")
    words = spark.createDataFrame([("ice",), ("police",), ("riot",)], "term string")
    got = {r.term: r.present for r in opinion.unigram_presence(rows, words, "id").collect()}
    assert got == {"ice": True, "police": False, "riot": False}
    pairs = spark.createDataFrame([("global", "warming"), ("police", "prevented"), ("love", "you")], "w1 string, w2 string")
    got = {(r.w1, r.w2): r.present for r in opinion.bigram_presence(rows, pairs, "id").collect()}
    assert got == {("global", "warming"): True, ("police", "prevented"): False, ("love", "you"): False}
