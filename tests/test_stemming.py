import random

from pyspark.sql import functions as F

from gleanery.functions import distances
from gleanery.operators import langmodel, stemming

# Examples from the published description of the algorithm.
STEMS = """
caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi enjoy enjoy
relational relat conditional condit rational ration valenci valenc digitizer digit radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous
formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt communism commun
activate activ effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll dying die skies sky died die spied spi yes ye by by
""".split()


def test_porter(spark):
    expected = dict(zip(STEMS[::2], STEMS[1::2]))
    rows = spark.createDataFrame([(w,) for w in expected], "word string")
    assert {r.word: r.stem for r in stemming.porter_stems(rows).collect()} == expected


def _distance(a, b, cost):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (0 if x == y else cost)))
        row = new
    return row[-1]


def test_costed_edit_distance(spark):
    rng = random.Random(8)
    pairs = [("".join(rng.choices("abc", k=rng.randrange(0, 7))), "".join(rng.choices("abc", k=rng.randrange(0, 7)))) for _ in range(200)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows.select(
        "i",
        distances.costed_edit_distance(a, b, 1).alias("one"),
        distances.costed_edit_distance(a, b, 2).alias("two"),
        distances.edit_distance(a, b).alias("jvm"),
    ).orderBy("i").collect()
    for (x, y), r in zip(pairs, got):
        assert r.one == r.jvm == _distance(x, y, 1)
        assert r.two == _distance(x, y, 2)
    swaps = spark.createDataFrame([("abc", "ca"), ("ab", "ba"), ("wants", "wasp")], "a string, b string")
    got = swaps.select(distances.costed_edit_distance(a, b, 1, True).alias("d")).collect()
    assert [r.d for r in got] == [2, 1, 3]


def test_trigram_discount(spark):
    counts = spark.createDataFrame(
        [("a", "b", "c", 3), ("a", "b", "d", 1), ("x", "b", "e", 2)], "w1 string, w2 string, w3 string, c long"
    )
    asked = spark.createDataFrame([("a", "b", "c"), ("a", "b", "e"), ("q", "b", "c")], "w1 string, w2 string, w3 string")
    got = {(r.w1, r.w3): r.p for r in langmodel.trigram_discount(asked, counts).collect()}
    assert got == {("a", "c"): (3 - 0.75) / 4, ("a", "e"): 2 * 0.75 / 4 * (1 / 1), ("q", "c"): 0.0}


def plain_distance(x, y, cost, swaps):
    table = {(i, j): max(i, j) for i in range(len(x) + 1) for j in range(len(y) + 1) if not i or not j}
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            same = x[i - 1] == y[j - 1]
            best = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (0 if same else cost))
            if swaps:
                rows = [r for r in range(1, i) if x[r - 1] == y[j - 1]]
                columns = [c for c in range(1, j) if y[c - 1] == x[i - 1]]
                if rows and columns:
                    r, c = rows[-1], columns[-1]
                    best = min(best, table[r - 1, c - 1] + (i - r - 1) + 1 + (j - c - 1))
            table[i, j] = best
    return table[len(x), len(y)]


def test_costed_edit_distance_of_random_words(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(9))) for _ in range(240)]
    pairs = list(zip(words[::2], words[1::2]))
    rows = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    cases = [(1, False), (2, False), (1, True), (2, True)]
    got = rows.select("a", "b", *[distances.costed_edit_distance(a, b, c, s).alias(f"d{i}") for i, (c, s) in enumerate(cases)])
    for r in got.collect():
        assert [r[f"d{i}"] for i in range(4)] == [plain_distance(r.a, r.b, c, s) for c, s in cases], r
    nothing = spark.createDataFrame([(None, "a")], "a string, b string")
    assert nothing.select(distances.costed_edit_distance(a, b).alias("d")).first().d is None
