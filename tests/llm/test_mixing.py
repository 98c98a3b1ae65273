import math

from pyspark.sql import functions as F

from gleanery.llm import mixing, queries
from corpus_cases import WORD


def fill(sizes: dict, weights=(5, 2, 1), share=1.5, epochs=2) -> dict:
    """Targets by reshared excess, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > epochs * sizes[s]}
        if not over:
            return found | {s: left * weight[s] / total for s in open_}
        found |= {s: float(epochs * sizes[s]) for s in over}
        left -= sum(found[s] for s in over)
        open_ -= over
    return found


def check(rows, sizes):
    want = fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.source_size == sizes[r.source]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        assert r.copies >= math.floor(r.target / r.source_size) if r.source_size else r.taken == 0
        taken[r.source] += r.taken
    for s in sizes:
        largest = max((r["size"] for r in rows if r.source == s), default=0)
        assert abs(taken[s] - want[s]) <= largest / 2 + 1e-9


def sums(rows):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    return sizes


def test_targets_and_takes(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = mixing.mixed(mixing.sized(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)).collect()
    check(rows, sums(rows))
    again = mixing.mixed(mixing.sized(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7), labels)).collect()
    assert sorted(rows) == sorted(again)


def test_sample_is_a_prefix_of_the_keys(spark):
    rows = [(i, "ab"[i % 2], 10, i * 0.5) for i in range(200)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, sample_key double")
    got = mixing.mixed(sized, weights=[3, 1]).filter("source = 'b'").orderBy("sample_key").collect()
    taken = [r.copies for r in got]
    assert taken == sorted(taken, reverse=True) and sum(taken) * 10 == round(got[0].target, -1)


def test_odd_rows(odd, labels, empty):
    rows = mixing.mixed(mixing.sized(odd, labels)).collect()
    texts = odd.select("doc_id", "text").collect()
    assert sorted(r["size"] for r in rows) == sorted(len(WORD.findall(t or "")) for _, t in texts)
    check(rows, sums(rows))
    mix = mixing.repeated(odd, labels)
    assert mix.columns == odd.columns
    got = mix.groupBy("doc_id", "text").count().collect()
    words = sum(len(WORD.findall(r.text or "")) * r["count"] for r in got)
    assert words == sum(r.taken for r in rows)
    assert mixing.mixed(mixing.sized(empty, labels)).count() == 0
    assert mixing.repeated(empty, labels).count() == 0


def test_weights_favour_good_documents(spark):
    keys = spark.range(20_000).select(
        mixing.sample_key("id", F.lit(2.0)).alias("good"), mixing.sample_key("id", F.lit(0.5)).alias("bad")
    )
    good, bad = keys.agg(F.avg("good"), F.avg("bad")).first()
    assert abs(good - 0.5) < 0.02 and abs(bad - 2) < 0.08


def test_query_columns(spark, sf_dir):
    assert queries.op3_mixing(spark, sf_dir).columns == ["doc_id", "size", "source_size", "target", "taken"]
