import hashlib

import public_tokenizers
import pytest
from corpus_cases import ODD

from gleanery.llm import byte_bpe, queries

RANKS = byte_bpe.read_ranks(public_tokenizers.path(queries.RANK_FILE))
ENCODER = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize(
    "text",
    ["", "a" * 120_000, " " * 120_000, "x y" * 50_000, "漢字" * 40_000, "é'll 're" * 20_000 + "  \n\n " * 9_000, "\x1c \x85\xa0 b" * 20_000,
     "<|endoftext|> " * 9_000],
)
def test_pieces_give_the_ids_of_the_whole(text):
    assert "".join(byte_bpe.pieces(text)) == text
    ids = byte_bpe.encode_text(ENCODER, text)
    assert ids == ENCODER.encode_ordinary(text)
    assert ENCODER.decode_bytes(ids) == text.encode()


def test_round_trip_of_odd_rows(odd, empty):
    encoded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert decoded.columns == [*odd.columns, "ids", "decoded"]
    rows = decoded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids == ENCODER.encode_ordinary(r.text or "")
    again = byte_bpe.encode(decoded.drop("decoded"), RANKS, public_tokenizers.PATTERN)
    assert again.columns == encoded.columns
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


def test_ids_that_end_inside_a_character(spark):
    ids = ENCODER.encode_ordinary("漢")
    rows = spark.createDataFrame([(ids[:1],), (None,), ([],)], "ids array<int>")
    got = [bytes(r.decoded) for r in byte_bpe.decode(rows, RANKS, public_tokenizers.PATTERN).collect()]
    assert got == [ENCODER.decode_single_token_bytes(ids[0]), b"", b""]


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: tuple(r) for r in queries.op1_byte_bpe(spark, sf_dir).collect()}
    for doc_id, text in texts:
        ids = ENCODER.encode_ordinary(text or "")
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id] == (doc_id, len(ids), joined, hashlib.sha256((text or "").encode()).hexdigest())
