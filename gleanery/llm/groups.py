"""Groups within sorted partitions, connected components, and the packing of texts for a shuffle."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.frames import kept

PACK_ROWS = 500


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch for each run of equal keys (integers without nulls) in a sorted partition.

    A run may cross batches; only the run at hand and one batch are held.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = last is not None and tuple(c[0] for c in columns) != last
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        last = tuple(c[-1] for c in columns)
        start = 0
        for cut in np.flatnonzero(new).tolist():
            if cut > start:
                held.append(batch.slice(start, cut - start))
            yield _joined(held)
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def spanning_edges(n: int, linked) -> list[tuple[int, int]]:
    """The connected components of a graph on 0..n-1 as stars: (least node, other node) for every other node.

    `linked(i, rest)` tells which of `rest` have an edge to i. Each node is compared only with nodes not reached yet, so
    a group that hangs together costs little more than its size.
    """
    edges = []
    rest = np.arange(n)
    while len(rest) > 1:
        centre = int(rest[0])
        queue, rest = [centre], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = linked(i, rest)
            found = rest[hit].tolist()
            edges += [(centre, j) for j in found]
            queue += found
            rest = rest[~hit]
    return edges


def in_blocks(df: DataFrame, blocks, salt) -> DataFrame:
    """Repeat each row of a group for every pair of the group's blocks that its own block is in.

    Adds `lo` and `hi`. Any two rows of a group meet in at least one (group, lo, hi), and no such part holds more than
    two blocks. A group of one block is one part.
    """
    block = F.pmod(salt, blocks)
    other = F.explode(
        F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(
            F.filter(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")), lambda o: o != F.col("_block"))
        )
    )
    df = df.withColumn("_block", block.cast("long")).withColumn("_other", other)
    return df.withColumns({"lo": F.least("_block", "_other"), "hi": F.greatest("_block", "_other")}).drop(
        "_block", "_other"
    )


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of the connected component of each node: (node, root), for nodes with an edge and root < node.

    `edges` has longs a and b. Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing
    changes; every round is written to the shared folder. The loop's driver sees a count and a checksum only.

    Every edge is held once, its larger node first. The larger neighbours of a node are then the edges that end in it,
    and its least neighbour is the least end of those that start from it, so neither step turns edges around.
    """
    state = kept(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (now := _checksum(state)) != before:
        before = now
        least = state.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        large = state.join(least, F.col("b") == F.col("node"), "left").select("a", F.coalesce("m", "b").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(lowest, "a").select(F.inline(ends))
        state = kept(small.filter("a <> b").distinct())
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def packed(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts of a batch, each compressed on its own: what a shuffle of whole texts moves."""
    press = zstandard.ZstdCompressor(level=1)
    column, parts = batch.column(text), [pa.array([], pa.binary())]
    for first in range(0, len(column), PACK_ROWS):  # few texts at a time are Python objects
        texts = column.slice(first, PACK_ROWS).to_pylist()
        parts.append(pa.array([press.compress((t or "").encode()) for t in texts], pa.binary()))
    return pa.concat_arrays(parts)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few rows, for work that makes Python objects of texts."""
    for batch in batches:
        for first in range(0, batch.num_rows, PACK_ROWS):
            yield batch.slice(first, PACK_ROWS)


def unpacked(column: pa.Array) -> pa.Array:
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(x).decode() for x in column.to_pylist()], pa.large_string())
