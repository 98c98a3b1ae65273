"""The pipeline against its stages done plainly."""

import math

import public_tokenizers
import pytest
from corpus_cases import WORD
from test_minhash_join import expected as near_expected
from test_mixing import check, sums

import corpus_pipeline
from gleanery.llm import byte_bpe, mixing, surrogates

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    """The documents that each stage has left, as the check tool and run() chain them."""
    folder = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    found["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def test_columns_stay(staged):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert staged[name].schema == staged["documents"].schema


def test_near_duplicates_stage(staged):
    before = [(r.doc_id, r.text) for r in staged["quality_rules"].collect()]
    kept = {i for i, _, _, stays in near_expected(before, 80, 5) if stays}
    assert sorted(r.doc_id for r in staged["near_duplicates"].collect()) == sorted(kept)


def test_personal_data_stage(staged):
    before = {r.doc_id: r.text for r in staged["near_duplicates"].collect()}
    after = {r.doc_id: r.text for r in staged["personal_data"].collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        found = surrogates.find(text or "")
        assert found or after[i] == text
        assert not any(text[a:b] in after[i] for a, b, _, _ in found)


def test_mixing_stage(spark, sf_dir, staged):
    docs = staged["personal_data"]
    plan = mixing.mixed(mixing.sized(docs, corpus_pipeline.labels(spark, sf_dir))).collect()
    check(plan, sums(plan))
    want = {r.doc_id: r.copies for r in plan if r.copies}
    got = staged["mixing"].groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == want
    words = sum(len(WORD.findall(r.text or "")) for r in staged["mixing"].collect())
    assert math.isclose(words, 1.5 * sum(r["size"] for r in plan), rel_tol=0.05)


def test_tokens_stage(staged):
    encoder = byte_bpe.encoding(
        byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE)), public_tokenizers.PATTERN
    )
    texts = {r.doc_id: r.text for r in staged["mixing"].collect()}
    rows = staged["byte_bpe"].collect()
    assert len(rows) == staged["mixing"].count()
    for r in rows:
        assert r.decodes_to_text and r.ids == encoder.encode_ordinary(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)


def test_run_equals_the_stages(spark, sf_dir, staged):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, staged["byte_bpe"].collect()))


def test_odd_documents(spark, odd, labels, empty, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.collect()
