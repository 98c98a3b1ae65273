import math

import pytest
from pyspark.sql import functions as F

from gleanery.functions import words as w
from gleanery.operators import normalize, sentence_ends, tagging


def _run(spark, text, column):
    row = spark.createDataFrame([(text,)], "t string")
    return row.select(column(F.col("t")).alias("x")).first().x


MUFFINS = "Good muffins cost $3.88 (roughly 3,36 euros)\nin New York.  Please buy me\ntwo of them.\nThanks."


def test_word_split(spark):
    assert _run(spark, MUFFINS, w.words) == (
        "Good muffins cost $ 3.88 ( roughly 3,36 euros ) in New York . Please buy me two of them . Thanks ."
    ).split()
    assert _run(spark, "hi, my name can't hello,", w.words) == ["hi", ",", "my", "name", "ca", "n't", "hello", ","]
    assert _run(spark, "They'll save and invest more.", w.words) == ["They", "'ll", "save", "and", "invest", "more", "."]
    assert _run(spark, 'I cannot say "wanna" -- \'tis Mr. Smith\'s...', w.words) == [
        "I", "can", "not", "say", "``", "wan", "na", "''", "--", "'t", "is", "Mr.", "Smith", "'s", "..."
    ]
    assert _run(spark, None, w.words) == []


def test_bracket_names(spark):
    named = _run(spark, "a (b) [c]", lambda t: w.words(t, name_brackets=True))
    assert named == ["a", "-LRB-", "b", "-RRB-", "-LSB-", "c", "-RSB-"]


def test_sentences(spark):
    text = 'Mr. Smith came. "Really?" he asked. Yes!  End'
    assert _run(spark, text, w.sentences) == ["Mr. Smith came.", '"Really?"', "he asked.", "Yes!", "End"]


def test_plain_tokenisers(spark):
    assert _run(spark, "Good $3.88, ok?", w.word_punct_tokens) == ["Good", "$", "3", ".", "88", ",", "ok", "?"]
    assert _run(spark, "a\n\n \nb\nc", w.blank_line_tokens) == ["a", "b\nc"]
    assert _run(spark, "a b\t c", w.white_space_tokens) == ["a", "b", "c"]
    assert _run(spark, "a\n\nb\n", w.line_tokens) == ["a", "b"]
    assert _run(spark, "a\n\nb\n", lambda t: w.line_tokens(t, "keep")) == ["a", "", "b"]
    assert _run(spark, "a  b", w.space_tokens) == ["a", "", "b"]
    assert _run(spark, "a\tb", w.tab_tokens) == ["a", "b"]


def test_multi_word_expressions(spark):
    row = spark.createDataFrame([("in a little or a little bit or a lot".split(),)], "t array<string>")
    merged = w.merge_expressions(F.col("t"), [["a", "little"], ["a", "little", "bit"], ["a", "lot"]])
    assert row.select(merged.alias("m")).first().m == ["in", "a_little", "or", "a_little_bit", "or", "a_lot"]


@pytest.fixture
def lemma_inputs(spark):
    table = spark.createDataFrame(
        [("dog", "n"), ("church", "n"), ("aardwolf", "n"), ("abacus", "n"), ("run", "v"), ("good", "a"), ("book", "n")],
        "lemma string, pos string",
    )
    exceptions = spark.createDataFrame([("abaci", "n", "abacus"), ("better", "a", "good")], "word string, pos string, lemma string")
    return table, exceptions


def test_lemmas(spark, lemma_inputs):
    cases = {("dogs", "n"): "dog", ("churches", "n"): "church", ("aardwolves", "n"): "aardwolf", ("abaci", "n"): "abacus",
             ("hardrock", "n"): "hardrock", ("better", "a"): "good", ("book", "n"): "book", ("dogs", "v"): "dogs",
             ("fast", "r"): "fast"}
    forms = spark.createDataFrame(list(cases), "word string, pos string")
    got = {(r.word, r.pos): r.lemma for r in normalize.lemmas(forms, *lemma_inputs).collect()}
    assert got == cases


def test_normalised_text(spark, lemma_inputs):
    rows = spark.createDataFrame([(1, "The dogs, the churches!"), (2, "4 5 !"), (3, None)], "id long, text string")
    tags = spark.createDataFrame([("dogs", "NNS", 3)], "word string, tag string, n long")
    stop = spark.createDataFrame([("the",)], "word string")
    done = normalize.normalized(
        rows, "id", tag_model=tags, lemma_table=lemma_inputs[0], exceptions=lemma_inputs[1], stop_words=stop
    )
    assert {r.id: r.tokens for r in done.collect()} == {1: ["dog", "church"], 2: [], 3: []}


def test_taggers(spark):
    corpus = [("the", "DT"), ("run", "NN"), ("to", "TO"), ("run", "VB"), ("run", "VB"), ("sadly", "RB"), ("madly", "RB")]
    tagged = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(corpus)], "s long, pos long, word string, tag string")
    uni = tagging.train_unigram(tagged)
    assert {r.word: r.tag for r in uni.collect()}["run"] == "VB"
    assert {r.word for r in tagging.train_unigram(tagged, cutoff=1).collect()} == {"run"}
    affixes = tagging.train_affix(tagged)
    assert {r.affix: r.tag for r in affixes.collect()} == {"dly": "RB"}
    bigram = tagging.train_bigram(tagged, ["s", "pos"], uni)
    assert [(r.previous, r.word, r.tag) for r in bigram.collect()] == [("DT", "run", "NN")]
    rows = spark.createDataFrame([(9, i, x) for i, x in enumerate(["the", "run", "run", "gladly", "xx"])], "s long, pos int, word string")
    by_word = tagging.tag_words(rows, uni, affixes).orderBy("pos").collect()
    assert [r.tag for r in by_word] == ["DT", "VB", "VB", "RB", "NN"]
    chain = tagging.tag_sequences(rows, "s", bigram, uni).first()
    assert chain.tags == ["DT", "NN", "VB", "NN", "NN"]
    classes = spark.createDataFrame([("JJ",), ("VBD",), ("RB",), ("NNP",), ("",)], "t string")
    assert [r.c for r in classes.select(tagging.word_class(F.col("t")).alias("c")).collect()] == ["a", "v", "r", "n", "n"]


def test_abbreviations_are_learned_and_keep_sentences_together(spark):
    texts = ["We ship approx. ten crates. They arrive approx. Monday. All is well, i.e. fine.", "Is it well? Ca. nine (approx. ten.) Then so. We ship. They arrive."] * 12
    texts += ["", None, "fine", "Well... it is fine. We ship ten crates and all arrive then"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ends = {r.word: (r.with_stop, r.without_stop) for r in sentence_ends.word_ends(docs).collect()}
    assert ends["approx"] == (36, 0) and ends["well"] == (0, 25) and ends["i.e"] == (12, 0) and ends["crates"] == (12, 1)
    known = sentence_ends.abbreviations(sentence_ends.word_ends(docs))
    total, stops = sum(a + b for a, b in ends.values()), sum(a for a, _ in ends.values())

    def score(word):
        yes, no = ends[word]
        logs = lambda p: yes * math.log(p) + no * math.log(1 - p + 1e-8)
        letters, inner = len(word.replace(".", "")), word.count(".")
        return -2 * (logs(stops / total) - logs(0.99)) * math.exp(-letters) * (inner + 1) * letters**-no

    expected = {w: score(w) for w, (yes, _) in ends.items() if yes and score(w) >= 0.3}
    got = {r.word: r.score for r in known.collect()}
    assert got == pytest.approx(expected) and {"ca", "i.e"} <= set(got)
    listed = spark.createDataFrame([("approx",), ("i.e",), ("ca",)], "word string")
    rows = sentence_ends.split(docs, listed).collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.pos)):
        by_doc.setdefault(r.doc_id, []).append(r.sentence)
    assert by_doc[0] == ["We ship approx. ten crates.", "They arrive approx. Monday.", "All is well, i.e. fine."]
    assert by_doc[1] == ["Is it well?", "Ca. nine (approx. ten.)", "Then so.", "We ship.", "They arrive."]
    assert by_doc[26] == ["fine"] and not {24, 25} & set(by_doc)
    assert by_doc[27] == ["Well...", "it is fine.", "We ship ten crates and all arrive then"]
