"""Order MinHash fingerprints, whose likeness follows the edit distance of texts.

A text's k-mers of characters are numbered by occurrence, so that a repeated k-mer counts again. Each of `n_hashes`
hash functions picks the `length` smallest numbered k-mers, puts them back in text order and hashes them as a tuple
(Marçais et al., 2019). The likeness of two fingerprints is the share of equal tuples. A text shorter than k is one
k-mer, an empty or null text has the fingerprint of no k-mers. Equal texts have equal fingerprints.

Hash values have 32 bits: the functions are odd multiples of one well-mixed value, so a minimum leads back to its
k-mer, and two k-mers of a text that share that value (rare) count as occurrences of one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.frames import text_bytes
from gleanery.llm.groups import packed, unpacked
from gleanery.llm.hashing import U64, mix

K = 8
GONE = np.iinfo(np.uint32).max
MULTIPLIERS = ((mix(np.arange(1, 1025, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)) | np.uint64(1)).astype(np.uint32)
N_HASHES = 32
LENGTH = 2
CHUNK_CHARS = 1 << 17
#: Text of a bucket; besides, a small table is cut into a few buckets.
BUCKET_BYTES = 4 << 20
LEAST_BUCKETS = 8
ROWS = 500

U32 = np.uint32


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, U32), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def kmer_values(points: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit value of each k-mer of each text, numbered by occurrence; and their offsets by text."""
    lengths = np.diff(offsets)
    counts = np.where(lengths >= k, lengths - k + 1, (lengths > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    padded = np.concatenate([points.astype(U64) + U64(1), np.zeros(k, U64)])
    rolled = np.zeros(len(points), U64)
    for j in range(k):
        rolled = rolled * U64(0x100000001B3) + padded[j : j + len(points)]
    at = np.arange(bounds[-1]) + np.repeat(offsets[:-1] - bounds[:-1], counts)
    values = rolled[at]
    for i in np.flatnonzero((lengths > 0) & (lengths < k)).tolist():
        short = 0
        for p in points[offsets[i] : offsets[i + 1]].tolist():
            short = (short * 0x100000001B3 + p + 1) % (1 << 64)
        values[bounds[i]] = short
    values = mix(values) >> U64(32)
    nth = occurrences(values, counts)
    return (mix(values + (nth.astype(U64) << U64(32))) >> U64(32)).astype(U32), bounds


def by_text(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit values in order of (text, value, place): text << 32 | value, and the places."""
    if len(counts) == 1:
        place = np.argsort(values, kind="stable")
        return values[place].astype(U64), place
    # Text 12 bits, value 32, place 20: sorting one word is far cheaper than sorting by several.
    text = np.repeat(np.arange(len(counts), dtype=U64), counts)
    key = np.sort((text << U64(52)) | (values.astype(U64) << U64(20)) | np.arange(len(values), dtype=U64))
    return key >> U64(20), (key & U64((1 << 20) - 1)).astype(np.int64)


def occurrences(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each value has come before in its text."""
    group, place = by_text(values, counts)
    n = len(values)
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(new)
    nth = np.empty(n, np.int64)
    nth[place] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return nth


def sketches(texts: list[str], k: int = K, n_hashes: int = N_HASHES, length: int = LENGTH) -> np.ndarray:
    """One row of `n_hashes` 32-bit tuple hashes for each text."""
    found = np.zeros((len(texts), n_hashes), U32)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + CHUNK_CHARS, side="right"))
        last = min(max(last, first + 1), first + 4096)
        _sketch(texts[first:last], found[first:last], k, n_hashes, length)
        first = last
    return found


def _sketch(texts: list[str], out: np.ndarray, k: int, n_hashes: int, length: int) -> None:
    points, offsets = code_points(texts)
    values, bounds = kmer_values(points, offsets, k)
    full = np.flatnonzero(np.diff(bounds))
    if len(full) == 0:
        return
    starts, counts = bounds[full], np.diff(bounds)[full]
    group, place = by_text(values, counts)
    owner = np.arange(len(full), dtype=U64) << U64(32)
    places = np.empty((length, len(full)), np.int64)
    chosen = np.empty((length, len(full)), U32)
    for h, m in enumerate(MULTIPLIERS[:n_hashes]):
        inverse = U32(pow(int(m), -1, 1 << 32))
        hashed = values * m
        for j in range(length):
            chosen[j] = np.minimum.reduceat(hashed, starts)
            found = np.searchsorted(group, owner | (chosen[j] * inverse).astype(U64))
            places[j] = place[np.minimum(found, len(place) - 1)]
            hashed[places[j]] = GONE
        tuple_hash = np.full(len(full), h, U64)
        for row in np.take_along_axis(chosen, np.argsort(places, axis=0, kind="stable"), axis=0):
            tuple_hash = mix(tuple_hash * U64(0x9E3779B97F4A7C15) + row.astype(U64) + U64(1))
        out[full, h] = (tuple_hash >> U64(32)).astype(U32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal tuples, row by row."""
    return (a == b).mean(axis=1)


def hexed(sketch: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in sketch]


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", k: int = K) -> DataFrame:
    """Add each text's fingerprint, in hexadecimal; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                found = hexed(sketches([t or "" for t in part.column(text).to_pylist()], k))
                columns = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], [*names, name])

    names = [c for c in docs.columns if c != name]
    fields = [f for f in docs.schema if f.name != name]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(name, T.StringType())]))


def after_next(docs: DataFrame, key: str, text: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Compressed texts in sorted partitions, each after the one that comes next in descending order of ids.

    Rows are ordered by id (null lowest) and text hash, and cut into buckets, runs whose bounds are approximate
    quantiles of the ids. The highest row of a bucket is also sent, as a guest, to the bucket above it, and that of
    the last bucket to the first: so the row in front of any other is its next. Bounds and highest rows are one value
    a bucket.
    """
    n_rows, size = text_bytes(docs, text)
    n = max(1, min(LEAST_BUCKETS + size // bucket_bytes, n_rows))
    quantiles = F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], max(10_000, 20 * n))
    bounds = np.unique(np.array(docs.agg(quantiles.alias("q")).first()["q"] or [], np.int64))

    def buckets_of(ids: pa.Array) -> np.ndarray:
        places = np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="left")
        places[ids.is_null().to_numpy(zero_copy_only=False)] = 0
        return places

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(buckets_of(batch.column("doc")), pa.int32()), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "doc", "tie"])

    keyed = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    highest = (
        keyed.drop("text")
        .mapInArrow(place, "bucket int, doc long, tie long")
        .groupBy("bucket")
        .agg(F.max(F.struct(F.col("doc").isNotNull().alias("known"), "doc", "tie")).alias("top"))
        .orderBy("bucket")
        .collect()
    )
    above = {r["bucket"]: highest[(i + 1) % len(highest)]["bucket"] for i, r in enumerate(highest)}
    tops = {r["bucket"]: (r["top"]["doc"], r["top"]["tie"]) for r in highest}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column("doc"), batch.column("tie")
            places = buckets_of(ids)
            rows = zip(places.tolist(), ids.to_pylist(), ties.to_pylist())
            guests = [i for i, (b, doc, tie) in enumerate(rows) if tops.get(b) == (doc, tie)]
            at = pa.array([*range(batch.num_rows), *guests], pa.int64())
            homes = np.concatenate([places, [above[places[i]] for i in guests]]).astype(np.int32)
            guest = np.arange(len(homes)) >= batch.num_rows
            texts = packed(batch, "text").take(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(homes), pa.array(guest), ids.take(at), ties.take(at), texts],
                ["bucket", "guest", "doc", "tie", "text"],
            )

    schema = "bucket int, guest boolean, doc long, tie long, text binary"
    order = ["bucket", F.desc("guest"), F.asc_nulls_first("doc"), "tie"]
    return keyed.mapInArrow(pack, schema).repartition(n, "bucket").sortWithinPartitions(*order)


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited (the text whose last third the start of the next one replaces), fingerprint,
    edited_fingerprint, near_edited and near_next. A single row is its own next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before, before_sketch = None, "", None
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                texts = unpacked(part.column("text")).to_pylist()
                own = sketches(texts)
                places, guests = part.column("bucket").to_pylist(), part.column("guest").to_pylist()
                rows, edited, next_sketches = [], [], []
                for i, body in enumerate(texts):
                    if places[i] == last and not guests[i]:
                        cut = len(body) // 3
                        rows.append(i)
                        edited.append(body[: len(body) - cut] + before[:cut])
                        next_sketches.append(before_sketch)
                    last, before, before_sketch = places[i], body, own[i]
                if not rows:
                    continue
                mine, changed = own[rows], sketches(edited)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(rows)),
                        pa.array([len(texts[i]) for i in rows], pa.int64()),
                        pa.array(edited, pa.string()),
                        pa.array(hexed(mine), pa.string()),
                        pa.array(hexed(changed), pa.string()),
                        pa.array(likeness(mine, changed)),
                        pa.array(likeness(mine, np.stack(next_sketches))),
                    ],
                    ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = (
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return after_next(docs, key, text).mapInArrow(run, schema)
