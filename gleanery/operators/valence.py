"""Lexicon- and rule-based sentiment: compound, positive, negative and neutral shares.

Every word is checked against the lexicon by a join, and only the hits, with the words
around them, go through the rules as columns.  One shuffle, on the review id.
"""

from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
BOOST = 0.293
CAPITALS = 0.733
NEGATION = -0.74
ALPHA = 15.0
DISTANCE_SCALE = {1: 1.0, 2: 0.95, 3: 0.9}

# Words that negate what follows.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
wouldn't rarely seldom despite
""".split()

# Words that strengthen, and words that weaken.
STRENGTHENERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely
especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin
fully fucking greatly hella highly hugely incredibly intensely majorly more most particularly
purely quite really remarkably so substantially thoroughly totally tremendously uber unbelievably
unusually utterly very
""".split()
DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely
slightly somewhat sorta sortof sort-of
""".split()
DAMPENING_PAIRS = ["just enough", "kind of", "sort of"]

# Phrases with a valence of their own.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# A word loses one of these marks, at one end.
EDGE_MARKS = r"[.!?,;:\-'\x22]|!!|!!!|\?\?|\?\?\?|\?!\?|!\?!|\?!\?!|!\?!\?"
PUNCTUATION = r"!-/:-@\[-`{-~"


@dataclass(frozen=True)
class Rules:
    """The word lists behind the rules; all are configuration, not data."""

    negations: list[str] = field(default_factory=lambda: NEGATIONS)
    strengtheners: list[str] = field(default_factory=lambda: STRENGTHENERS)
    dampeners: list[str] = field(default_factory=lambda: DAMPENERS)
    dampening_pairs: list[str] = field(default_factory=lambda: DAMPENING_PAIRS)
    idioms: dict[str, float] = field(default_factory=lambda: IDIOMS)


def words(text: Column) -> Column:
    """Blank-separated words of two characters or more, freed of a mark at one end.

    The marks are taken off in one pass over the text, before it is split.
    """
    plain = f"([^{PUNCTUATION}\\s\\x1c-\\x1f]{{2,}})"
    edge = r"(?U)(?<=^|[\s\x1c-\x1f])"
    stripped = F.regexp_replace(
        text, f"{edge}(?:(?:{EDGE_MARKS}){plain}|{plain}(?:{EDGE_MARKS}))(?=$|[\\s\\x1c-\\x1f])", "$1$2"
    )
    return F.filter(F.split(stripped, r"(?U)[\s\x1c-\x1f]+"), lambda w: F.length(w) > 1)


def _among(column: str, listed: list[str], lower: bool = True) -> Column:
    """Membership in a configured list, written as one expression text: cheap to build and plan."""
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in listed)
    return F.expr(f"lower({column}) IN ({quoted})" if lower else f"{column} IN ({quoted})")


def _upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _emphasis(text: Column) -> Column:
    exclamations = F.least(F.regexp_count(text, F.lit("!")), F.lit(4)) * F.lit(0.292)
    n = F.regexp_count(text, F.lit("\\?"))
    questions = F.when(n <= 1, 0.0).when(n <= 3, n * F.lit(0.18)).otherwise(0.96)
    return exclamations + questions


def _word_rows(reviews: DataFrame, key: str, text: Column) -> DataFrame:
    """One row per word with its neighbours, and one marker row (null word) per review."""
    split = reviews.select(key, _emphasis(text).alias("emphasis"), words(text).alias("ws"))
    # No letter but these has them as its lower case.
    spellings = ["".join(letters) for letters in product("bB", "uU", "tT")]
    described = split.select(
        key,
        "emphasis",
        "ws",
        F.size("ws").alias("n_words"),
        (F.exists("ws", _upper) & F.exists("ws", lambda w: ~_upper(w))).alias("mixed_case"),
        F.least(*[F.nullif(F.array_position("ws", F.lit(s)), F.lit(0)) for s in spellings]).alias("but_at"),
    )
    # Slices side by side, which generated code builds; a lambda would be interpreted at every word. The marker comes first.
    n_rows = F.size("ws") + 1

    def before(by: int) -> Column:
        return F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), by + 1), F.col("ws")), F.lit(1), n_rows)

    def after(by: int) -> Column:
        return F.concat(F.array(F.lit(None).cast("string")), F.slice("ws", by + 1, n_rows))

    names = ["w", "p1", "p2", "p3", "n1", "n2"]
    rows = F.arrays_zip(before(0), before(1), before(2), before(3), after(1), after(2)).cast(
        "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"
    )
    found = described.select(key, "emphasis", "n_words", "mixed_case", "but_at", F.posexplode(rows).alias("pos", "_at"))
    return found.select(key, "emphasis", "n_words", "mixed_case", "but_at", F.col("pos").cast("long").alias("pos"), "_at.*")


def _with_lexicon_flag(rows: DataFrame, lexicon: DataFrame, neighbour: str) -> DataFrame:
    flag = lexicon.select(F.col("word").alias(f"l_{neighbour}"), F.lit(True).alias(f"in_{neighbour}"))
    return rows.join(flag, F.lower(neighbour) == F.col(f"l_{neighbour}"), "left").drop(f"l_{neighbour}")


def _valence(rules: Rules) -> list[tuple[str, Column]]:
    """The rule chain as successive definitions of `v`."""
    low = {c: F.lower(c) for c in ("w", "p1", "p2", "p3")}
    mixed = F.col("mixed_case")
    v = F.col("v")

    def negates(c: str) -> Column:
        return _among(c, rules.negations) | low[c].contains("n't")

    def boost(c: str) -> Column:
        base = F.when(_among(c, rules.strengtheners), BOOST).when(
            _among(c, rules.dampeners + rules.dampening_pairs), -BOOST
        )
        signed = F.when(v < 0, -base).otherwise(base)
        loud = _upper(F.col(c)) & mixed
        shouted = signed + F.when(v > 0, CAPITALS).otherwise(-CAPITALS)
        return F.coalesce(F.when(loud, shouted).otherwise(signed), F.lit(0.0))

    def active(k: int) -> Column:
        return F.col(f"p{k}").isNotNull() & F.col(f"in_p{k}").isNull()

    so_this = ["so", "this"]
    never2 = (F.col("p2") == "never") & F.col("p1").isin(so_this)
    never3 = ((F.col("p3") == "never") & F.col("p2").isin(so_this)) | F.col("p1").isin(so_this)
    negate = {
        1: F.when(negates("p1"), v * NEGATION).otherwise(v),
        2: F.when(never2, v * 1.5).when(negates("p2"), v * NEGATION).otherwise(v),
        3: F.when(never3, v * 1.25).when(negates("p3"), v * NEGATION).otherwise(v),
    }

    def idiom(*parts: str) -> Column:
        phrase = F.concat_ws(" ", *parts)
        chain = F.lit(None).cast("double")
        for text, value in rules.idioms.items():
            if len(text.split(" ")) == len(parts):
                chain = F.when(phrase == text, value).otherwise(chain)
        return chain

    before = F.coalesce(
        idiom("p1", "w"), idiom("p2", "p1", "w"), idiom("p2", "p1"),
        idiom("p3", "p2", "p1"), idiom("p3", "p2"),
    )
    after2 = F.when(F.col("n1").isNotNull(), idiom("w", "n1"))
    after3 = F.when(F.col("n2").isNotNull(), idiom("w", "n1", "n2"))
    pairs = rules.dampening_pairs
    dampened = F.concat_ws(" ", "p3", "p2").isin(pairs) | F.concat_ws(" ", "p2", "p1").isin(pairs)

    capitals = F.when(v > 0, v + CAPITALS).otherwise(v - CAPITALS)
    chain = [("v", F.when(_upper(F.col("w")) & mixed, capitals).otherwise(v))]
    for k in (1, 2, 3):
        chain.append(("v", F.when(active(k), v + boost(f"p{k}") * DISTANCE_SCALE[k]).otherwise(v)))
        chain.append(("v", F.when(active(k), negate[k]).otherwise(v)))
    chain.append(("v", F.when(active(3), F.coalesce(after3, after2, before, v)).otherwise(v)))
    chain.append(("v", F.when(active(3) & dampened, v - BOOST).otherwise(v)))
    least = active(1) & (low["p1"] == "least")
    spared = F.coalesce(low["p2"].isin("at", "very"), F.lit(False))
    chain.append(("v", F.when(least & ~spared, v * NEGATION).otherwise(v)))
    return chain


# Sums of doubles depend on their order; as decimals they do not.
def _exact(value: Column) -> Column:
    return value.cast("decimal(28,12)")


def _sum_exact(value: Column) -> Column:
    return F.coalesce(F.sum(_exact(value)), F.lit(0)).cast("double")


def polarity_scores(
    reviews: DataFrame,
    lexicon: DataFrame,
    key: str = "reviewId",
    text: Column | None = None,
    rules: Rules | None = None,
    first_context: bool = True,
) -> DataFrame:
    """neg, neu, pos (3 places) and compound (4 places) of every review.

    `first_context=True` judges a repeated word by the words around its first occurrence;
    otherwise each occurrence is judged where it stands.
    """
    rules = rules or Rules()
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    lexicon = lexicon.groupBy("word").agg(F.max("measure").alias("measure"))
    boosters = rules.strengtheners + rules.dampeners + rules.dampening_pairs

    rows = _word_rows(reviews, key, text)
    matched = rows.join(lexicon, F.lower("w") == F.col("word"), "left").where(
        "pos = 0 or measure is not null"
    )
    # One exchange on the id serves both aggregations below.
    placed = matched.repartition(key)

    scalars = ["emphasis", "n_words", "mixed_case", "but_at"]
    context = ["p1", "p2", "p3", "n1", "n2"]
    before_but = F.when(F.col("but_at").isNull(), 0).when(F.col("pos") < F.col("but_at"), 1).otherwise(0)
    after_but = F.when(F.col("but_at").isNull(), 0).when(F.col("pos") > F.col("but_at"), 1).otherwise(0)
    spot = placed.withColumns({"n_before": before_but, "n_after": after_but, "n_here": F.lit(1)})
    if first_context:
        spot = (
            spot.groupBy(key, "w", "measure", *scalars)
            .agg(
                F.min(F.struct("pos", *context)).alias("first"),
                F.sum("n_before").alias("n_before"),
                F.sum("n_after").alias("n_after"),
                F.sum("n_here").alias("n_here"),
            )
            .select("*", "first.*")
        )
    for neighbour in ("p1", "p2", "p3"):
        spot = _with_lexicon_flag(spot, lexicon, neighbour)

    spot = spot.withColumn("v", F.col("measure"))
    for name, column in _valence(rules):
        spot = spot.withColumn(name, column)
    kind_of = F.coalesce((F.lower("w") == "kind") & (F.lower("n1") == "of"), F.lit(False))
    silent = F.col("w").isNull() | _among("w", boosters) | kind_of
    spot = spot.withColumn("v", F.when(silent, 0.0).otherwise(F.col("v")))

    # Occurrences before the first "but" weigh half, those after it one and a half.
    v = F.col("v")
    n_plain = F.col("n_here") - F.col("n_before") - F.col("n_after")
    weighted = v * 0.5 * F.col("n_before") + v * 1.5 * F.col("n_after") + v * n_plain
    n_here = F.col("n_here")
    per_review = spot.groupBy(key).agg(
        _sum_exact(weighted).alias("s"),
        _sum_exact(F.when(v > 0, weighted + n_here)).alias("pos_sum"),
        _sum_exact(F.when(v < 0, -weighted + n_here)).alias("neg_sum"),
        F.sum(F.when(v != 0, n_here).otherwise(0)).alias("n_scored"),
        F.max("n_words").alias("n_words"),
        F.max("emphasis").alias("emphasis"),
    )

    e = F.col("emphasis")
    s = F.col("s")
    scored = (
        per_review.withColumn("s", F.when(s > 0, s + e).when(s < 0, s - e).otherwise(s))
        .withColumn("neu_sum", (F.col("n_words") - F.col("n_scored")).cast("double"))
        .withColumns(
            {
                "p": F.when(F.col("pos_sum") > F.col("neg_sum"), F.col("pos_sum") + e).otherwise(F.col("pos_sum")),
                "q": F.when(F.col("pos_sum") < F.col("neg_sum"), F.col("neg_sum") + e).otherwise(F.col("neg_sum")),
            }
        )
        .withColumn("total", F.col("p") + F.col("q") + F.col("neu_sum"))
    )

    def share(part: str) -> Column:
        return F.when(F.col("n_words") > 0, F.bround(F.col(part) / F.col("total"), 3)).otherwise(0.0)

    compound = F.when(F.col("n_words") > 0, F.bround(s / F.sqrt(s * s + F.lit(ALPHA)), 4)).otherwise(0.0)
    return scored.select(
        key,
        share("q").alias("neg"),
        share("neu_sum").alias("neu"),
        share("p").alias("pos"),
        compound.alias("compound"),
    )
