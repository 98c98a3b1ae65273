"""Equal items of each row's list, found a batch of rows at a time: one row for each distinct item, nothing shuffled."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Rows whose items are sorted together; bounds what a task holds beside its batch.
ROWS = 128


def _starts(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Where a new item begins, in sorted order."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return np.flatnonzero(new)


def _grouped(part: pa.RecordBatch, n_keep: int) -> list[pa.Array]:
    lists = part.column(n_keep)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.argsort(row * np.int64(max(len(coded.dictionary), 1)) + code, kind="stable")
    starts = _starts(row[order], code[order])
    ends = np.append(starts, len(order)).astype("int32")
    columns = [part.column(i).take(pa.array(row[order][starts])) for i in range(n_keep)]
    columns.append(coded.dictionary.take(pa.array(code[order][starts])))
    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order].astype("int32"))))
    return columns


def item_places(documents: DataFrame, keep: list[str], items: Column, item: str) -> DataFrame:
    """keep, `item`, places: each distinct item of a row's list with the places, from 0, at which it stands."""
    rows = documents.select(*keep, items.alias("_items"))
    schema = rows.select(*keep).schema.add(item, T.StringType()).add("places", T.ArrayType(T.IntegerType()))
    names = schema.names

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield pa.RecordBatch.from_arrays(_grouped(batch.slice(at, ROWS), len(keep)), names=names)

    return rows.mapInArrow(grouped, schema)
