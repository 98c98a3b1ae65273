"""Exact repeats of word passages, found by fixed-block anchors.

A window is `size` consecutive words of one document. Every window that repeats an earlier one holds a whole block of
size/2 words of the earlier document's fixed, non-overlapping blocks. So blocks are the index: a document probes it with every
rolling window of size/2 words, and a hit, a window that equals a block found elsewhere too, is extended by comparing
the whole windows around it. Words covered by a window whose words also start earlier are repeats; maximal repeats
are the unions of such windows.

Documents, in order of id (null last, repeated ids by text), are cut into buckets, runs of about equal count whose
number follows from the bytes of text, and hashes into shards. All that moves is packed by bucket and shard:

1. A bucket sends each shard the sorted distinct hashes of its rolling windows, with a flag where one is a block. A
   passage that fills a third of all rows is thus sent once by each bucket.
2. A shard answers each bucket with the hashes that are hits.
3. A bucket extends the hits: it sends the 64-bit hashes of the whole windows around them.
4. A shard answers, in the order of the hashes, whether an earlier bucket has sent the same. With a window's first
   start inside its bucket this tells every repeat.

Texts are compressed and shuffled by bucket once; all steps that need them read that exchange.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.frames import text_bytes
from gleanery.llm.groups import packed, unpacked
from gleanery.llm.hashing import U64, buffers, gram_starts, grams, word_bounds, word_hashes

WINDOW = 20
#: Text of a bucket. Messages number buckets times shards, so corpora of many terabytes want larger buckets.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 16
MESSAGE = "bucket int, shard int, kind int, data binary"
HASH, ANSWER, OWN = 0, 1, 2


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: sorted hashes become byte planes of their differences."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        body = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts += [np.array([len(a), a.itemsize], np.int64).tobytes(), body]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueezed(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count, at, found = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(count):
        n, width = np.frombuffer(raw, np.int64, 2, at).tolist()
        planes = np.frombuffer(raw, np.uint8, n * width, at + 16).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"u{width}"))
        at += 16 + n * width
    return found


def differences(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    """By the low half of a hash; the high half then still tells the hashes of a shard apart."""
    return ((hashes & U64(0xFFFFFFFF)) % U64(n_shards)).astype(np.int64)


def split_by_shard(hashes: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the hashes by shard and value, and the shards' bounds in it."""
    by_value = np.argsort(hashes)
    shards = shard_of(hashes, n_shards)[by_value]
    kind = np.uint16 if n_shards < 1 << 16 else np.int64
    by_shard = np.argsort(shards.astype(kind), kind="stable")
    return by_value[by_shard], np.searchsorted(shards[by_shard], np.arange(n_shards + 1))


class Bucket:
    """The documents of one bucket, in order, with the hashes of all their windows."""

    def __init__(self, table: pa.Table, size: int) -> None:
        ids = table.column("doc").combine_chunks()
        texts = unpacked(table.column("text").combine_chunks())
        order = np.lexsort(
            (table.column("tie").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        )
        self.ids, self.texts = ids.take(pa.array(order)), texts.take(pa.array(order))
        self.words, self.offsets = word_hashes(self.texts)
        self.half, self.size = size // 2, size

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of windows of `size` words, where they start, and their offsets by document."""
        starts, offsets = gram_starts(self.offsets, size)
        return grams(self.words, size)[starts], starts, offsets

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the half windows, whether each is a block of the index, and which one each start has."""
        hashes, starts, offsets = self.windows(self.half)
        in_doc = starts - np.repeat(self.offsets[:-1], np.diff(offsets))
        distinct, which = np.unique(hashes, return_inverse=True)
        block = np.zeros(len(distinct), bool)
        block[which[in_doc % self.half == 0]] = True
        return distinct, block, which

    def extended(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the whole windows that hold a hit, and where they start; `hits` are half-window hashes, sorted."""
        halves, starts, _ = self.windows(self.half)
        place = np.searchsorted(hits, halves) if len(hits) else np.zeros(len(halves), np.int64)
        hit = np.zeros(len(self.words) + 1, np.int64)
        if len(hits):
            hit[starts] = hits[np.minimum(place, len(hits) - 1)] == halves
        before = np.concatenate([[0], np.cumsum(hit)])
        whole, at, _ = self.windows(self.size)
        near = before[at + self.size - self.half + 1] > before[at]
        return whole[near], at[near]


def batch_of(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["bucket", "shard", "kind", "data"]
    )


def in_buckets(docs: DataFrame, key: str, text: str, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Compressed texts in buckets of neighbouring ids, shuffled by bucket; and the number of buckets.

    The bounds are approximate quantiles of the ids, one value a bucket.
    """
    _, size = text_bytes(docs, text)
    n = LEAST_BUCKETS + size // bucket_bytes
    quantiles = F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 20 * n))
    bounds = np.array(docs.agg(quantiles.alias("q")).first()["q"] or [], np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(key).cast(pa.int64())
            places = np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="left")
            places[ids.is_null().to_numpy(zero_copy_only=False)] = n - 1
            texts = packed(batch, text)
            ties = [zlib.crc32((t or "").encode()) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), ids, pa.array(ties, pa.int64()), texts], ["bucket", "doc", "tie", "text"]
            )

    frame = docs.select(key, text).mapInArrow(pack, "bucket int, doc long, tie long, text binary")
    return frame.repartition(n, "bucket"), n


def repeats(
    docs: DataFrame, finish, schema: str, key: str = "doc_id", text: str = "text", size: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Find the repeats and let `finish(ids, texts, offsets, repeated)` make each bucket's rows of `schema`.

    `repeated` flags the words of all texts in order, `offsets` says where each text's words begin.
    """
    buckets, n_buckets = in_buckets(docs, key, text, bucket_bytes)
    n_shards = n_buckets

    def send(table: pa.Table) -> pa.Table:
        bucket = Bucket(table, size)
        own = table.column("bucket")[0].as_py()
        hashes, block, _ = bucket.probes()
        order, bounds = split_by_shard(hashes, n_shards)
        rows = []
        for shard in range(n_shards):
            part = order[bounds[shard] : bounds[shard + 1]]
            if len(part):
                short = hashes[part] >> U64(32)
                rows.append((own, shard, HASH, squeezed(differences(short.astype(np.uint32)), np.packbits(block[part]))))
        return batch_of(rows)

    def find_hits(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        owners = table.column("bucket").to_pylist()
        sent = [unsqueezed(d) for d in table.column("data").to_pylist()]
        hashes = [np.cumsum(s[0], dtype=np.uint32) for s in sent]
        flags = [np.unpackbits(s[1], count=len(h)).astype(bool) for s, h in zip(sent, hashes)]
        flat, block = np.concatenate(hashes), np.concatenate(flags)
        distinct, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
        indexed = np.zeros(len(distinct), bool)
        indexed[which[block]] = True
        hit = (indexed & (counts > 1))[which]
        at, rows = 0, []
        for own, h in zip(owners, hashes):
            rows.append((own, shard, ANSWER, squeezed(np.packbits(hit[at : at + len(h)]))))
            at += len(h)
        return batch_of(rows)

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = Bucket(table, size)
        own = table.column("bucket")[0].as_py()
        hits = found_hits(bucket, answers)
        whole = np.unique(bucket.extended(hits)[0])
        order, bounds = split_by_shard(whole, n_shards)
        rows = [(own, n_shards + own, OWN, squeezed(differences(hits)))]
        for shard in range(n_shards):
            part = order[bounds[shard] : bounds[shard + 1]]
            if len(part):
                rows.append((own, shard, HASH, squeezed(differences(whole[part]))))
        return batch_of(rows)

    def found_hits(bucket: Bucket, answers: pa.Table) -> np.ndarray:
        """Hashes that some shard has found elsewhere, and those that occur twice in the bucket and are blocks."""
        hashes, block, which = bucket.probes()
        order, bounds = split_by_shard(hashes, n_shards)
        hit = block & (np.bincount(which, minlength=len(hashes)) > 1) if len(hashes) else block
        for shard, data in zip(answers.column("shard").to_pylist(), answers.column("data").to_pylist()):
            part = order[bounds[shard] : bounds[shard + 1]]
            hit[part] |= np.unpackbits(unsqueezed(data)[0], count=len(part)).astype(bool)
        return hashes[hit]

    def compare(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard >= n_shards:  # a bucket's hits, which it has sent to itself
            return table.select(["bucket", "shard", "kind", "data"])
        table = table.sort_by("bucket")
        owners = table.column("bucket").to_pylist()
        hashes = [np.cumsum(unsqueezed(d)[0], dtype=U64) for d in table.column("data").to_pylist()]
        _, first = np.unique(np.concatenate(hashes), return_index=True)
        later = np.ones(sum(map(len, hashes)), bool)
        later[first] = False
        at, rows = 0, []
        for own, h in zip(owners, hashes):
            rows.append((own, shard, ANSWER, squeezed(np.packbits(later[at : at + len(h)]))))
            at += len(h)
        return batch_of(rows)

    def conclude(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = Bucket(table, size)
        hits, later = np.zeros(0, U64), {}
        for shard, kind, data in zip(*(answers.column(c).to_pylist() for c in ("shard", "kind", "data"))):
            if kind == OWN:
                hits = np.cumsum(unsqueezed(data)[0], dtype=U64)
            else:
                later[shard] = unsqueezed(data)[0]
        found, starts = bucket.extended(hits)
        distinct, first, which = np.unique(found, return_index=True, return_inverse=True)
        order, bounds = split_by_shard(distinct, n_shards)
        elsewhere = np.zeros(len(distinct), bool)
        for shard, bits in later.items():
            part = order[bounds[shard] : bounds[shard + 1]]
            elsewhere[part] = np.unpackbits(bits, count=len(part)).astype(bool)
        repeat = elsewhere[which] if len(which) else np.zeros(0, bool)
        again = np.ones(len(found), bool)
        again[first] = False
        starts = starts[repeat | again]
        edges = np.zeros(len(bucket.words) + 1, np.int64)
        edges[starts] += 1
        edges[starts + size] -= 1
        return finish(bucket.ids, bucket.texts, bucket.offsets, np.cumsum(edges)[:-1] > 0)

    sent = buckets.groupBy("bucket").applyInArrow(send, MESSAGE)
    hits = sent.groupBy("shard").applyInArrow(find_hits, MESSAGE)
    wholes = buckets.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(extend, MESSAGE)
    answers = wholes.groupBy("shard").applyInArrow(compare, MESSAGE)
    return buckets.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(conclude, schema)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and kept, the words left joined by one space.

    A null text has no words; a text shorter than a window has no repeats.
    """

    def finish(ids, texts, offsets: np.ndarray, repeated: np.ndarray) -> pa.Table:
        data, at = buffers(texts)
        kept, removed = [], []
        for i in range(len(texts)):
            body = data[at[i] : at[i + 1]]
            gone = repeated[offsets[i] : offsets[i + 1]]
            starts, ends, _ = word_bounds(body, np.array([0, len(body)]))
            raw = body.tobytes()
            kept.append(b" ".join([raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist())]).decode())
            removed.append(int(gone.sum()))
        return pa.table(
            [ids.cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )

    return repeats(docs, finish, "doc_id long, n_words long, n_removed long, kept string", key, text, size)
