import zlib
from collections import defaultdict

import pytest
from corpus_cases import ODD
from pyspark.sql import functions as F

from gleanery.llm import hilbert, queries


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dimensions, bits):
    side = 1 << bits
    cells = [(F.col("id") / side**i).cast("long") % side for i in range(dimensions)]
    rows = spark.range(side**dimensions).select(hilbert.curve_index(cells, bits).alias("h"), *cells).collect()
    order = sorted(tuple(r) for r in rows)
    assert [r[0] for r in order] == list(range(side**dimensions))
    for a, b in zip(order, order[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def check(rows, n_shards=24):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(0 <= s < n_shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1


def test_query(spark, sf_dir, texts):
    rows = queries.op10_hilbert(spark, sf_dir).collect()
    check(rows)
    got = {r.doc_id: (r["size"], r.text_crc32) for r in rows}
    assert got == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts}
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_runs_keep_sources_together(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = hilbert.sharded(docs, 8).join(docs.select("doc_id", "source"), "doc_id")
    spread = shards.groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n")).first()[0]
    assert spread < docs.select("source").distinct().count() * 0.8


def test_odd_rows(odd, empty):
    rows = hilbert.sharded(odd, 5).collect()
    check(rows, 5)
    assert sorted(r.text_crc32 for r in rows) == sorted(zlib.crc32((t or "").encode()) for _, t in ODD)
    assert hilbert.sharded(empty).count() == 0
