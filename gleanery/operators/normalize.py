"""Text normalisation: words, tags, stop-word and letter filters, lemmas."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.tokenize import merged_text
from gleanery.functions.words import words
from gleanery.operators.row_items import item_places
from gleanery.operators.tagging import DEFAULT_TAG, word_class
from gleanery.operators.word_blocks import blocks, unpacked, word_counts

# Suffix -> ending of the candidate lemma, per word class.
SUFFIXES = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
          ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""),
          ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
    "r": [],
}


def token_rows(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per token: key, pos, token."""
    return documents.select(key, F.posexplode(words(F.col(text))).alias("pos", "token"))


def lemmas(forms: DataFrame, lemma_table: DataFrame, exceptions: DataFrame) -> DataFrame:
    """The shortest known candidate of every (word, pos); the word itself when none is known.

    Candidates are the word and either its listed exceptions or what the suffix rules make
    of it.  `forms` holds each (word, pos) once; `lemma_table` has (lemma, pos), `exceptions`
    (word, pos, lemma).
    """
    listed = exceptions.groupBy("word", "pos").agg(F.sort_array(F.collect_set("lemma")).alias("listed"))
    word = F.col("word")

    def stripped(ending: str, new: str):
        cut = F.concat(F.expr(f"substring(word, 1, length(word) - {len(ending)})"), F.lit(new))
        return F.when(word.endswith(ending), cut)

    by_rule = F.array().cast("array<string>")
    for pos, rules in SUFFIXES.items():
        if rules:
            by_rule = F.when(F.col("pos") == pos, F.array(*[stripped(a, b) for a, b in rules])).otherwise(by_rule)
    candidates = F.concat(F.array(word), F.coalesce("listed", by_rule))
    known = lemma_table.select(F.col("lemma").alias("candidate"), "pos").distinct()
    found = (
        forms.join(listed, ["word", "pos"], "left")
        .select("word", "pos", F.posexplode(candidates).alias("place", "candidate"))
        .where("candidate is not null")
        .join(known, ["candidate", "pos"])
        .groupBy("word", "pos")
        .agg(F.min(F.struct(F.length("candidate").alias("size"), "place", "candidate")).alias("best"))
        .select("word", "pos", F.col("best.candidate").alias("lemma"))
    )
    return forms.join(found, ["word", "pos"], "left").withColumn("lemma", F.coalesce("lemma", "word"))


def normal_forms(
    tokens: DataFrame,
    tag_model: DataFrame,
    lemma_table: DataFrame,
    exceptions: DataFrame,
    default_tag: str = DEFAULT_TAG,
) -> DataFrame:
    """token -> normal form, for every distinct token.

    Tags depend on the word alone, so all the work is on distinct tokens.
    """
    distinct = tokens.select("token").distinct().withColumn("word", F.lower("token"))
    tags = tag_model.select(F.col("word").alias("token"), "tag")
    tagged = distinct.join(tags, "token", "left").withColumn(
        "pos", word_class(F.coalesce("tag", F.lit(default_tag)))
    )
    forms = lemmas(tagged.select("word", "pos").distinct(), lemma_table, exceptions)
    return tagged.join(forms, ["word", "pos"]).select("token", "lemma")


def token_places(documents: DataFrame, key: str, stop_words: DataFrame, text: str = "text") -> DataFrame:
    """key, token, places: one row for each distinct letter token of a text that is no stop word.

    Each text is cut once and grouped within its row, so doubles and stop words go before anything is shuffled.
    """
    found = item_places(documents, [key], words(F.col(text)), "token").where(F.col("token").rlike(r"^\p{L}+$"))
    return found.join(stop_words.select("word"), F.lower("token") == F.col("word"), "left_anti")


def _normal_lists(packs: DataFrame, forms: DataFrame) -> DataFrame:
    """_key, places, lemmas: the texts of the blocks as the normal forms of their tokens, with the places of these."""
    met = packs.select("block", F.posexplode("words").alias("place", "token")).join(forms, "token").select("block", "place", "lemma")

    def listed(own: pa.Table, met: pa.Table) -> pa.Table:
        if not len(own):
            return pa.table({name: pa.array([], kind) for name, kind in (("_key", own.schema.field("_key").type.value_type), ("places", pa.list_(pa.int32())), ("lemmas", pa.list_(pa.string())))})
        met = met.sort_by([("place", "ascending"), ("lemma", "ascending")])
        lengths, places = unpacked(own.column("lengths")[0].as_py()), unpacked(own.column("places")[0].as_py())
        # The last one is that of a null token's place, -1.
        n = np.bincount(met.column("place").to_numpy(), minlength=own.column("n_words")[0].as_py() + 1)
        first, times = np.cumsum(n) - n, n[places]
        spot = np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(first[places] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        ends = np.append(0, np.cumsum(times))[np.append(0, np.cumsum(lengths))]
        ends = pa.array(ends, pa.int32())
        lemmas = met.column("lemma").combine_chunks().take(pa.array(at))
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.repeat(spot, times), pa.int32())), pa.ListArray.from_arrays(ends, lemmas)]
        return pa.Table.from_arrays([own.column("_key").combine_chunks().flatten(), *lists], names=["_key", "places", "lemmas"])

    key = packs.schema["_key"].dataType.elementType
    schema = T.StructType([T.StructField("_key", key), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("lemmas", T.ArrayType(T.StringType()))])
    own = packs.select(F.col("block").alias("own"), F.size("words").alias("n_words"), "lengths", "places", "_key")
    return own.groupBy("own").cogroup(met.groupBy("block")).applyInArrow(listed, schema)


def normalized(
    documents: DataFrame, key: str, text: str = "text", *, stop_words: DataFrame, **models: DataFrame
) -> DataFrame:
    """key and `tokens`: lemmas in text order, doubles kept; an empty list where nothing is left.

    The texts are cut once and lie in the shared folder as blocks. Distinct tokens get their forms; what a block has of them
    meets its texts in one row, so that a token is moved once for each block and not for each text. Rows of one key, if there
    are any, share their tokens in the order of their places; a row without a key has none.
    """
    packs = blocks(documents.withColumn("_key", F.col(key)), words(F.col(text)), ["_key"])
    tokens = word_counts(packs).select(F.col("word").alias("token")).where(F.col("token").rlike(r"^\p{L}+$"))
    tokens = tokens.join(stop_words.select("word"), F.lower("token") == F.col("word"), "left_anti")
    rows = _normal_lists(packs, normal_forms(tokens, **models))
    none = F.array().cast("array<string>")
    counted = packs.select(F.explode("_key").alias("_key")).where("_key IS NOT NULL").groupBy("_key").agg(F.count("*").alias("n"))
    if counted.where("n > 1").isEmpty():
        return rows.select(F.col("_key").alias(key), F.when(F.col("_key").isNotNull(), F.col("lemmas")).otherwise(none).alias("tokens"))
    lists = rows.groupBy("_key").agg(
        F.count("*").alias("_rows"), F.collect_list(F.when(F.col("_key").isNotNull(), F.struct("places", "lemmas"))).alias("_found")
    )
    zipped = F.transform("_found", lambda f: F.arrays_zip(f["places"], f["lemmas"]))
    merged = F.sort_array(F.flatten(zipped))["lemmas"]
    tokens = F.when(F.size("_found") == 0, none).when(F.size("_found") == 1, F.col("_found")[0]["lemmas"]).otherwise(merged)
    return lists.select(F.col("_key").alias(key), tokens.alias("tokens"), F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).select(key, "tokens")


def processed(reviews: DataFrame, null_as: str = "", **models: DataFrame) -> DataFrame:
    """Reviews with all their columns and `tokens`, the normal forms of summary and body."""
    text = merged_text(F.col("summary"), F.col("reviewText"), null_as)
    tokens = normalized(reviews.select("reviewId", text.alias("text")), "reviewId", **models)
    return reviews.join(tokens, "reviewId")
