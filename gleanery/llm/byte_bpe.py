"""Byte-level BPE: texts to token ids and back, by a rank file on local disk.

The tiktoken library merges; this module splits long texts first, reads the rank file once on the driver, sends it to
the tasks (a vocabulary's size is fixed) and decodes ids to raw bytes, so that a token that ends inside a character is
no loss. A null text counts as empty, and an empty text has no ids. No shuffle; rows keep their other columns.

A long text is cut only in front of a space or line break that follows something else than white space. No match of
the split pattern runs across such a place (a match holds white space only at its start, or is nothing but white
space), so the pieces have the same ids as the whole. A text without such a place stays whole.
"""

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleanery.llm.hashing import buffers, row_chunks, text_column

PIECE_CHARS = 50_000
DECODE_ROWS = 500
SAFE_CUT = re.compile(r"\S(?=[ \n])")

_encodings: dict[str, tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, built once in each Python worker."""
    name = hashlib.sha256(pattern.encode() + b"\n" + ranks).hexdigest()
    if name not in _encodings:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _encodings[name] = tiktoken.Encoding(
            name,
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
    return _encodings[name]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of `size` characters or somewhat more, whose ids add up to those of the text."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def encode_text(encoder: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return encoder.encode_ordinary(text)
    return [i for piece in pieces(text) for i in encoder.encode_ordinary(piece)]


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], [*names, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column; a column already called `ids` is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            column = text_column(batch.column(text))
            _, offsets = buffers(column)
            for first, last in row_chunks(offsets):
                part = batch.slice(first, last - first)
                found = [encode_text(encoder, t) for t in column.slice(first, last - first).to_pylist()]
                yield _with_column(part, ids, pa.array(found, pa.list_(pa.int32())))

    return docs.mapInArrow(run, _schema(docs, ids, T.ArrayType(T.IntegerType())))


def verified(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column, and `decodes_to_text`: whether their bytes are the text's.

    Encodes and decodes in one Python worker, where `encode` and `decode` in a row hold two for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            column = text_column(batch.column(text))
            for first, last in row_chunks(buffers(column)[1]):
                texts = column.slice(first, last - first).to_pylist()
                found = [encode_text(encoder, t) for t in texts]
                whole = [encoder.decode_bytes(i) == t.encode() for i, t in zip(found, texts)]
                part = _with_column(batch.slice(first, last - first), ids, pa.array(found, pa.list_(pa.int32())))
                yield _with_column(part, "decodes_to_text", pa.array(whole, pa.bool_()))

    fields = [f for f in docs.schema if f.name not in (ids, "decodes_to_text")]
    fields += [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField("decodes_to_text", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType(fields))


def decode(tokens: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add the raw bytes that a column of token ids stands for; null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            column = batch.column(ids)
            starts = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).cumsum().tolist()
            for first in range(0, len(column), DECODE_ROWS):
                rows = range(first, min(first + DECODE_ROWS, len(column)))
                done = starts[first - 1] if first else 0
                flat = column.slice(first, len(rows)).flatten().to_numpy().tolist()
                bounds = [0] + [starts[i] - done for i in rows]
                found = [encoder.decode_bytes(flat[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield _with_column(batch.slice(first, len(rows)), data, pa.array(found, pa.binary()))

    return tokens.mapInArrow(run, _schema(tokens, data, T.BinaryType()))
