import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import ratings
from gleanery.operators import ranking, termstats
from gleanery.sinks import files
from gleanery.sources import arrivals, json_lines, lexicons, tables


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "reviews.json"
    rows = [
        json.dumps({"category": "Book", "reviewText": "good", "overall": 5.0}),
        "{broken",
        json.dumps({"reviewText": "no category"}),
        json.dumps({"category": "Book", "reviewText": None, "overall": "abc"}),
        "3",
    ]
    path.write_text("\n".join(rows))
    return str(path)


def test_tolerant_lines(spark, lines):
    rows = json_lines.read_reviews(spark, lines)
    kept = termstats.category_sizes(rows).collect()
    assert [(r.category, r.n_c) for r in kept] == [("Book", 2)]
    bands = [r.b for r in rows.where("category is not null").select(ratings.rating_band(F.col("overall")).alias("b")).collect()]
    assert sorted(bands, key=str) == [None, "positive"]


def test_strict_lines_fail(spark, lines):
    with pytest.raises(Exception):
        json_lines.read_reviews(spark, lines, "strict").collect()


def test_permissive_lines_give_null_rows(spark, lines):
    rows = json_lines.read_reviews(spark, lines, "permissive")
    assert json_lines.labelled_text(rows).count() == 1


def test_rejects(spark, lines):
    rows = json_lines.read_reviews_with_rejects(spark, lines).collect()
    assert [r.rejected for r in rows] == [False, True, False, False, True]
    assert rows[0].review.category == "Book"


def test_array_and_object_files(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([{"category": "a"}, {"category": "b"}], indent=1))
    (tmp_path / "one.json").write_text(json.dumps({"category": "c"}, indent=1))
    for name, expected in (("array", ["a", "b"]), ("one", ["c"])):
        rows = json_lines.read_reviews(spark, str(tmp_path / f"{name}.json"), multi_line=True)
        assert [r.category for r in rows.collect()] == expected


def test_lexicons(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("The\n and \n\nthe\n")
    assert sorted(r.word for r in lexicons.read_stop_words(spark, str(tmp_path / "stop.txt")).collect()) == ["and", "the"]
    (tmp_path / "bad.txt").write_text("Darn\n a@$$ \n")
    assert [r.word for r in lexicons.read_bad_words(spark, str(tmp_path / "bad.txt")).collect()] == ["Darn", "a@$$"]
    (tmp_path / "val.txt").write_text("good\t1.9\t0.5\t[1, 2]\nbad\t-2.5\n")
    got = {r.word: r.measure for r in lexicons.read_valence_lexicon(spark, str(tmp_path / "val.txt")).collect()}
    assert got == {"good": 1.9, "bad": -2.5}
    with pytest.raises(ValueError):
        lexicons.read_valence_lexicon(spark, None)


RECORD = '{"s3":{"bucket":{"name":"b"},"object":{"key":"a+b%2Ec.json"}}}'


@pytest.mark.parametrize(
    "text, n", [('{"Records":[%s]}' % RECORD, 1), (f"[{RECORD},{RECORD}]", 2), (RECORD, 1), ('{"Event":"s3:TestEvent"}', 0)]
)
def test_envelopes(spark, text, n):
    rows = arrivals.envelope_records(spark.createDataFrame([(text,)], "envelope string")).collect()
    assert [(r.bucket, r.key) for r in rows] == [("b", "a b.c.json")] * n


@pytest.mark.parametrize("text", ['{"x":1}', '"text"'])
def test_unexpected_envelopes_fail(spark, text):
    with pytest.raises(Exception, match="unexpected event shape"):
        arrivals.envelope_records(spark.createDataFrame([(text,)], "envelope string")).collect()


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("B", "x y"), ("A", "z w")], "category string, reviewText string")
    lines = ranking.ranked_lines(ranking.top_terms(termstats.chi2_scores(rows.select("category", F.lit("aa bb").alias("reviewText")).unionByName(spark.createDataFrame([("B", "cc")], rows.schema)))))
    files.write_ranked_lines(lines, str(tmp_path / "ranked"))
    text = (tmp_path / "ranked").glob("part-*")
    written = [line for f in text for line in f.read_text().splitlines()]
    assert [line.split(" ")[0] for line in written] == ["A", "B", "aa"]
    terms = spark.createDataFrame([("b",), ("a",), ("é",)], "term string")
    files.write_vocabulary(terms, str(tmp_path / "vocab"))
    assert [f.read_text() for f in (tmp_path / "vocab").glob("part-*")] == ["a\nb\né\n"]
    numbered = spark.range(20).select(F.format_string("devset-%06d", "id").alias("sourceId"), F.lit("t").alias("reviewText"))
    files.write_landing_zone(numbered, str(tmp_path / "landing"), 4, limit=10)
    back = json_lines.read_reviews(spark, str(tmp_path / "landing"))
    assert back.count() == 10 and back.agg(F.max("sourceId")).first()[0] == "devset-000009"
    files.write_landing_zone(numbered, str(tmp_path / "all"), 4, limit=0)
    assert json_lines.read_reviews(spark, str(tmp_path / "all")).count() == 20


def test_tables_keep_their_splits_unless_told(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "doc_id").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    wanted = spark.conf.get(tables.PARTITIONS_KEY)
    try:
        spark.conf.unset(tables.PARTITIONS_KEY)
        assert tables.table(spark, str(tmp_path), "documents").rdd.getNumPartitions() == 1
        spark.conf.set(tables.PARTITIONS_KEY, "3")
        assert tables.table(spark, str(tmp_path), "documents").rdd.getNumPartitions() == 3
    finally:
        spark.conf.set(tables.PARTITIONS_KEY, wanted)


def test_shared_folder_is_the_cluster_setting(spark):
    assert tables.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
