"""Maximum entropy over the presence of terms, by generalised iterative scaling (Darroch and Ratcliff, 1972).

A feature is a pair of a term and a label that occur together in training; every such pair has a weight, however many there
are. A correction feature fills each document up to the same number of features under every label. A round compares
how often features occurred with how often the model expects them, both counted by aggregates, and shifts each weight by
the logarithm of their ratio over that number. Weights stay a table; nothing of the vocabulary's size reaches the driver.

Documents are packed into blocks of some BLOCK occurrences of terms, and the distinct terms of all blocks are dealt into shares of
some LINKS terms of blocks, both once. A share holds the weights of its terms, and where the blocks have them. A round sends each
block the weights of its distinct terms and gets back how often it expects them, a share and a block in one row of compressed
numbers; so what it moves grows with the distinct terms of the blocks and not with the occurrences times the labels.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.word_blocks import packed as bytes_of
from gleanery.operators.word_blocks import unpacked
from gleanery.sources.tables import ensure_checkpoint_dir

#: Occurrences of terms (a document has one for each of its distinct terms) in a block of documents, about.
BLOCK = 2_000_000
#: Terms of blocks in a share, about.
LINKS = 500_000


@dataclass
class MaxentModel:
    """weights: term, label, weight. Documents have at most `filled` features, and the correction weighs `correction`."""

    weights: DataFrame
    labels: list
    correction: float
    filled: int


def _packed(terms: DataFrame, keys: DataFrame, n_present: int) -> DataFrame:
    """block, keys and times (of each document, the latter among the rows), docs and places (the document and the term of each
    occurrence, by document), terms (the frequent ones first)."""
    block = F.pmod(F.xxhash64("key"), F.lit(n_present // BLOCK + 1)).alias("block")
    found = terms.where("term IS NOT NULL").select(block, "key", "term")
    times = keys.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("times")).select(block, "key", "times")
    kind = keys.schema["key"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("times", T.ArrayType(T.LongType())),
        T.StructField("docs", T.ArrayType(T.IntegerType())), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("terms", T.ArrayType(T.StringType())),
    ])

    def pack(group: pa.Table, rows: pa.Table) -> pa.Table:
        key, known = (t.column("key").combine_chunks() for t in (group, rows))
        row = pc.index_in(key, value_set=known.cast(key.type)) if len(group) and len(rows) else pa.nulls(len(group), pa.int32())
        kept = pc.filter(row, row.is_valid()).to_numpy(zero_copy_only=False)
        coded = pc.filter(group.column("term").combine_chunks(), row.is_valid()).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        used, docs = np.unique(kept, return_inverse=True)
        order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        rank = np.zeros(len(order), np.int32)
        rank[order] = np.arange(len(order))
        by_doc = np.argsort(docs, kind="stable")
        lists = [
            known.take(pa.array(used)), rows.column("times").combine_chunks().take(pa.array(used)), pa.array(docs[by_doc], pa.int32()),
            pa.array(rank[codes][by_doc], pa.int32()), coded.dictionary.take(pa.array(order)),
        ]
        n = int(len(codes) > 0)
        ends = [pa.ListArray.from_arrays(pa.array([0, len(x)] if n else [0], pa.int32()), x) for x in lists]
        return pa.Table.from_arrays([pa.array(group.column("block").to_pylist()[:n], pa.int64()), *ends], names=["block", "keys", "times", "docs", "places", "terms"])

    return found.groupBy("block").cogroup(times.groupBy("block")).applyInArrow(pack, schema)


def _compact(packs: DataFrame) -> DataFrame:
    """`_packed` with compressed numbers: block, rows (that its documents stand for), times, docs, places, terms."""

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                times, docs, places = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("times", "docs", "places"))
                made = [bytes_of(times), bytes_of(np.diff(docs, prepend=0).astype(np.int32)), bytes_of(places)]
                rows = pa.array([int(times.sum())], pa.int64())
                columns = [batch.column("block").slice(i, 1), rows, *[pa.array([x], pa.binary()) for x in made], batch.column("terms").slice(i, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "rows", "times", "docs", "places", "terms"])

    schema = "block long, rows long, times binary, docs binary, places binary, terms array<string>"
    return packs.select("block", "times", "docs", "places", "terms").mapInArrow(compact, schema)


SHARE = "share long, terms array<string>, seen binary, weights binary, blocks binary, counts binary, places binary, spots binary, filling double"


def _share(values: dict) -> pa.Table:
    kinds = {"share": pa.int64(), "terms": pa.list_(pa.string()), "filling": pa.float64()}
    return pa.table({name: pa.array([value], kinds.get(name, pa.binary())) for name, value in values.items()})


def _no_share() -> pa.Table:
    return _share({f.split()[0]: None for f in SHARE.split(", ")}).slice(0, 0)


def _shares(needed: DataFrame, wide: DataFrame, k: int, n_shares: int) -> DataFrame:
    """For each share its terms, how often they were seen with each label, their weights, and which place each block gives them."""
    share = F.pmod(F.xxhash64("term"), F.lit(n_shares)).alias("share")

    def made(links: pa.Table, own: pa.Table) -> pa.Table:
        if not len(own):
            return _no_share()
        terms = own.column("term").combine_chunks()
        links = links.sort_by([("block", "ascending"), ("place", "ascending")])
        spots = pc.index_in(links.column("term").combine_chunks(), value_set=terms).to_numpy(zero_copy_only=False).astype(np.int32) if len(links) else np.zeros(0, np.int32)
        blocks, counts = np.unique(links.column("block").to_numpy(), return_counts=True)
        seen = np.stack([pc.fill_null(own.column(f"seen{i}").cast(pa.float64()), math.nan).to_numpy() for i in range(k)])
        return _share({
            "share": own.column("share")[0].as_py(), "terms": terms.to_pylist(), "seen": bytes_of(seen.ravel()),
            "weights": bytes_of(np.where(np.isnan(seen), np.nan, 0.0).ravel()), "blocks": bytes_of(blocks.astype(np.int64)),
            "counts": bytes_of(counts.astype(np.int32)), "places": bytes_of(links.column("place").to_numpy().astype(np.int32)), "spots": bytes_of(spots), "filling": 0.0,
        })

    links = needed.select(share, "block", "place", "term")
    own = wide.where("term IS NOT NULL").select(share, "term", *[f"seen{i}" for i in range(k)])
    return links.groupBy("share").cogroup(own.groupBy("share")).applyInArrow(made, SHARE)


def _given(shares: DataFrame, k: int) -> DataFrame:
    """block, share, places, values: the weights of a share's terms, for each block that has some of them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for share, weights, blocks, counts, places, spots in zip(*(c.to_pylist() for c in batch.columns)):
                weights, blocks = unpacked(weights, np.float64).reshape(k, -1), unpacked(blocks, np.int64)
                places, spots, ends = unpacked(places), unpacked(spots), np.append(0, np.cumsum(unpacked(counts)))
                cuts = [slice(ends[i], ends[i + 1]) for i in range(len(blocks))]
                columns = [
                    pa.array(blocks, pa.int64()), pa.array([share] * len(blocks), pa.int64()), pa.array([bytes_of(places[c]) for c in cuts], pa.binary()),
                    pa.array([bytes_of(weights[:, spots[c]].ravel()) for c in cuts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "share", "places", "values"])

    return shares.select("share", "weights", "blocks", "counts", "places", "spots").mapInArrow(send, "block long, share long, places binary, values binary")


def _expected(packs: DataFrame, given: DataFrame, k: int, correction: float, filled: int) -> DataFrame:
    """of (a share), block, values: how often a block expects a share's terms under each label; and its filling, in one of its rows."""

    def expect(blocks: pa.Table, given: pa.Table) -> pa.Table:
        made = {"of": [], "block": [], "values": [], "filling": []}
        if len(blocks):
            times, docs, places = (unpacked(blocks.column(c)[0].as_py(), kind) for c, kind in (("times", np.int64), ("docs", np.int32), ("places", np.int32)))
            docs = np.cumsum(docs)
            held = np.full((k, blocks.column("n_terms")[0].as_py()), np.nan)
            ats = [unpacked(at) for at in given.column("places").to_pylist()]
            for at, values in zip(ats, given.column("values").to_pylist()):
                held[:, at] = unpacked(values, np.float64).reshape(k, -1)
            has, weight = ~np.isnan(held), np.nan_to_num(held)
            n = np.column_stack([np.bincount(docs, has[i][places], len(times)) for i in range(k)])
            s = np.column_stack([np.bincount(docs, weight[i][places], len(times)) for i in range(k)]) + (filled - n) * correction
            raw = np.exp(s - s.max(1, keepdims=True))
            p = raw / raw.sum(1, keepdims=True) * times[:, None]
            counted = np.stack([np.where(has[i], np.bincount(places, p[docs, i], held.shape[1]), 0.0) for i in range(k)])
            made["of"] = given.column("share").to_pylist()
            made["block"] = blocks.column("own").to_pylist() * len(ats)
            made["values"] = [bytes_of(counted[:, at].ravel()) for at in ats]
            made["filling"] = [float((p * (filled - n)).sum()), *[0.0] * (len(ats) - 1)][: len(ats)]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.float64()]
        return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(made.items(), kinds)})

    own = packs.select(F.col("block").alias("own"), "times", "docs", "places", F.size("terms").alias("n_terms"))
    return own.groupBy("own").cogroup(given.groupBy("block")).applyInArrow(expect, "of long, block long, values binary, filling double")


def _moved(shares: DataFrame, found: DataFrame, k: int, filled: int) -> DataFrame:
    """The shares with their weights shifted by a round, and the filling of the blocks that reported it to them."""

    def move(own: pa.Table, found: pa.Table) -> pa.Table:
        if not len(own):
            return _no_share()
        values = {name: own.column(name)[0].as_py() for name in own.column_names}
        seen, weights = (unpacked(values[c], np.float64).reshape(k, -1) for c in ("seen", "weights"))
        spots, ends = unpacked(values["spots"]), np.append(0, np.cumsum(unpacked(values["counts"])))
        at = {block: i for i, block in enumerate(unpacked(values["blocks"], np.int64).tolist())}
        expected = np.zeros(seen.shape)
        found = found.sort_by("block")
        for block, part in zip(found.column("block").to_pylist(), found.column("values").to_pylist()):
            expected[:, spots[ends[at[block]] : ends[at[block] + 1]]] += unpacked(part, np.float64).reshape(k, -1)
        known = expected > 0
        shift = np.log(np.where(known, seen, 1.0) / np.where(known, expected, 1.0)) / filled
        values["weights"] = bytes_of(np.where(known, weights + shift, np.nan).ravel())
        values["filling"] = float(sum(found.column("filling").to_pylist()))
        return _share(values)

    return shares.groupBy("share").cogroup(found.groupBy("of")).applyInArrow(move, SHARE)


def _listed(shares: DataFrame, k: int) -> DataFrame:
    """term, w0, w1, ...: a row for each term that has a weight."""
    names = [f"w{i}" for i in range(k)]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, weights in zip(batch.column("terms"), batch.column("weights").to_pylist()):
                weights = unpacked(weights, np.float64).reshape(k, -1)
                yield pa.RecordBatch.from_arrays([terms.values, *[pa.array(w, from_pandas=True) for w in weights]], names=["term", *names])

    return shares.select("terms", "weights").mapInArrow(listed, ", ".join(["term string", *[f"{name} double" for name in names]]))


def _wide(pairs: DataFrame, labels: list, value: str, name: str) -> DataFrame:
    """A row for each term with a column for each label, null where the pair is missing."""
    columns = [F.max(F.when(F.col("label") == label, F.col(value))).alias(f"{name}{i}") for i, label in enumerate(labels)]
    return pairs.groupBy("term").agg(*columns)


def train(present: DataFrame, rows: DataFrame, key: str, label: str, rounds: int = 10) -> MaxentModel:
    """`present` has a row for each distinct term of a document; `rows` has all documents. Labels are few, and reach the driver."""
    ensure_checkpoint_dir(rows.sparkSession)
    keys = rows.select(F.col(key).alias("key"))
    labels = [r[0] for r in rows.select(label).distinct().orderBy(label).collect()]
    terms = present.select(F.col(key).alias("key"), F.col(label).alias("own"), "term")
    pairs = terms.groupBy("term", F.col("own").alias("label")).agg(F.count("*").alias("seen")).checkpoint()
    sizes = terms.groupBy("key").agg(F.count("*").alias("n"))
    n_rows = keys.count()
    filled, n_present = sizes.agg(F.max("n"), F.sum("n")).first()
    if not filled:
        return MaxentModel(pairs.select("term", "label", F.lit(0.0).alias("weight")), labels, 0.0, 0)
    seen_correction = n_rows * filled - n_present
    k, correction = len(labels), 0.0
    packs = _compact(_packed(terms, keys, n_present)).checkpoint()
    n_packed, n_links = (n or 0 for n in packs.agg(F.sum("rows"), F.sum(F.size("terms"))).first())
    needed = packs.select("block", F.posexplode("terms").alias("place", "term"))
    shares = _shares(needed, _wide(pairs, labels, "seen", "seen"), k, n_links // LINKS + 1).checkpoint()
    for _ in range(rounds):
        found = _expected(packs, _given(shares, k), k, correction, filled)
        shares = _moved(shares, found, k, filled).checkpoint()
        # Documents without terms are filled up under every label.
        filling = (shares.agg(F.sum("filling")).first()[0] or 0.0) + (n_rows - n_packed) * filled
        if seen_correction > 0 and filling > 0:
            correction += float(math.log(seen_correction / filling)) / filled
    listed = F.array(*[F.struct(F.lit(name).alias("label"), F.col(f"w{i}").alias("weight")) for i, name in enumerate(labels)])
    return MaxentModel(_listed(shares, k).select("term", F.inline(listed)).where("weight IS NOT NULL"), labels, correction, filled)


def _guesses(packs: DataFrame, met: DataFrame, labels: list, correction: float, filled: int) -> DataFrame:
    """key, guess: the place of the label of a document's highest score; `met` has the weights of the blocks' known terms."""
    k, kind = len(labels), packs.schema["keys"].dataType.elementType

    def guess(blocks: pa.Table, met: pa.Table) -> pa.Table:
        if not len(blocks):
            return pa.table({"key": pa.array([], blocks.schema.field("keys").type.value_type), "guess": pa.array([], pa.int32())})
        keys, docs, places = (blocks.column(c).combine_chunks().flatten() for c in ("keys", "docs", "places"))
        docs, places = docs.to_numpy(), places.to_numpy()
        at, scores = met.column("place").to_numpy(), np.zeros((len(keys), k))
        for i in range(k):
            held = np.full(blocks.column("n_terms")[0].as_py(), np.nan)
            held[at] = pc.fill_null(met.column(f"w{i}"), math.nan).to_numpy()
            n = np.bincount(docs, ~np.isnan(held)[places], len(keys))
            scores[:, i] = np.bincount(docs, np.nan_to_num(held)[places], len(keys)) + (filled - n) * correction
        return pa.table({"key": keys, "guess": pa.array(np.round(scores, 9).argmax(1), pa.int32())})

    own = packs.select(F.col("block").alias("own"), "keys", "docs", "places", F.size("terms").alias("n_terms"))
    schema = T.StructType([T.StructField("key", kind), T.StructField("guess", T.IntegerType())])
    return own.groupBy("own").cogroup(met.groupBy("block")).applyInArrow(guess, schema)


def classify(model: MaxentModel, present: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Add `predicted`: the label of the highest score (rounded to nine digits; of equal ones the first label).

    A block's distinct terms meet their weights; of a document only its guess leaves the block. Without terms all scores are equal.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    keys = rows.select(F.col(key).alias("key"))
    terms = present.select(F.col(key).alias("key"), "term")
    packs = _packed(terms, keys, terms.count()).checkpoint()
    needed = packs.select("block", F.posexplode("terms").alias("place", "term"))
    wide = _wide(model.weights, model.labels, "weight", "w")
    met = needed.join(wide, "term").select("block", "place", *[f"w{i}" for i in range(len(model.labels))])
    guesses = _guesses(packs, met, model.labels, model.correction, model.filled)
    names = F.array(*[F.lit(name) for name in model.labels])
    scored = keys.where("key IS NOT NULL").distinct().join(guesses, "key", "left")
    guess = F.element_at(names, F.coalesce("guess", F.lit(0)) + 1)
    return rows.join(scored.select("key", guess.alias("predicted")), rows[key] == F.col("key")).drop("key")
