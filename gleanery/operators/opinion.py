"""Polarity votes, negation scope and presence features over word lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.tokenize import letter_words

# Words that open a negation scope, and marks that close it.
SCOPE_OPENERS = """
never no nothing nowhere noone none not havent hasnt hadnt cant couldnt shouldnt wont wouldnt
dont doesnt didnt isnt arent aint
""".split()
CLAUSE_MARKS = [".", ":", ";", "!", "?"]


def polarity_vote(documents: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """Positive against negative lexicon words; ties and misses are neutral.

    A null word stands for the document itself, so that one without any hit is kept
    without a second scan or a join back.
    """
    words = documents.select(
        key, F.explode(F.concat(F.array(F.lit(None).cast("string")), letter_words(F.col("text")))).alias("word")
    )
    hits = words.join(lexicon, "word", "left").where("word is null or measure is not null")
    votes = hits.groupBy(key).agg(
        F.count_if(F.col("measure") > 0).alias("n_pos"), F.count_if(F.col("measure") < 0).alias("n_neg")
    )
    polarity = (
        F.when(F.col("n_pos") > F.col("n_neg"), "positive")
        .when(F.col("n_pos") < F.col("n_neg"), "negative")
        .otherwise("neutral")
    )
    return votes.withColumn("polarity", polarity)


def mark_negation(tokens: Column, extra_negations: list[str] = [], double_flip: bool = False) -> Column:
    """Append _NEG to the tokens between a negation and the next clause mark.

    With `double_flip` every further negation of the clause closes or reopens the scope;
    otherwise it is marked like any other token.

    The list is cut at the clause marks and each clause at its negations, which keeps the
    work linear in the length of the text.
    """
    openers = SCOPE_OPENERS + list(extra_negations)

    def tagged(token: Column) -> Column:
        negation = token.isin(openers) | token.contains("n't")
        return (
            F.when(negation, F.concat(F.lit("\x02"), token))
            .when(token.isin(CLAUSE_MARKS), F.concat(token, F.lit("\x03")))
            .otherwise(token)
        )

    def marked(token: Column, piece: Column, place: Column) -> Column:
        word = F.regexp_replace(token, "[\\x02\\x03]", "")
        opens = (place == 0) & (F.lit(True) if double_flip else piece == 1)
        inside = (piece % 2 == 1) if double_flip else (piece >= 1)
        scoped = inside & ~opens & ~token.endswith("\x03")
        return F.when(scoped, F.concat(word, F.lit("_NEG"))).otherwise(word)

    def clause(text: Column) -> Column:
        # The leading \x04 keeps a clause that starts with a negation from losing piece 0.
        pieces = F.split(F.concat(F.lit("\x04\x01"), text), "\x01(?=\x02)")
        done = F.transform(
            pieces,
            lambda p, k: F.transform(F.split(p, "\x01"), lambda t, j: marked(t, k, j)),
        )
        return F.filter(F.flatten(done), lambda t: ~t.isin("\x04", ""))

    joined = F.array_join(F.transform(tokens, tagged), "\x01")
    return F.flatten(F.transform(F.split(joined, "(?<=\x03)\x01"), clause))


def clause_tokens(text: Column) -> Column:
    """Words (with their apostrophes) and clause marks."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}']+|[.:;!?]"), F.lit(0))


def negation_marked(documents: DataFrame, key: str, extra_negations: list[str] = []) -> DataFrame:
    tokens = F.coalesce(clause_tokens(F.col("text")), F.array().cast("array<string>"))
    return documents.select(key, mark_negation(tokens, extra_negations).alias("tokens"))


def unigram_presence(documents: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """One row per document and wanted term, true where the document holds it.

    The wanted list is a configuration value: one row of the plan, not a join partner.
    """
    terms = wanted.agg(F.sort_array(F.collect_set("term"))).scalar()
    words = documents.select(key, F.array_distinct(letter_words(F.col("text"))).alias("ws"), terms.alias("ts"))
    hit = F.array_intersect("ts", "ws")
    return words.select(key, hit.alias("hit"), F.explode("ts").alias("term")).select(
        key, "term", F.array_contains("hit", F.col("term")).alias("present")
    )


def bigram_presence(documents: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    pairs = wanted.agg(F.sort_array(F.collect_set(F.concat_ws(" ", "w1", "w2")))).scalar()
    words = documents.select(key, letter_words(F.col("text")).alias("ws"), pairs.alias("ts"))
    bigrams = F.zip_with(
        "ws", F.slice("ws", 2, F.greatest(F.size("ws") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    found = words.select(key, "ts", F.array_intersect("ts", bigrams).alias("hit"))
    return found.select(key, "hit", F.explode("ts").alias("pair")).select(
        key,
        F.split_part("pair", F.lit(" "), F.lit(1)).alias("w1"),
        F.split_part("pair", F.lit(" "), F.lit(2)).alias("w2"),
        F.array_contains("hit", F.col("pair")).alias("present"),
    )
