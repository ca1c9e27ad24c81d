"""Connected components by smallest labels, and counts of hashes in a table of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.sources import scratch

# A table of counts has this many cells, whatever is counted: 16 MB on the driver, 4 MB of it sent to tasks.
CELL_BITS = 22
_BLOCK = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b): the smallest node that it reaches.

    First every node keeps one edge, to its smallest neighbour below, and its other neighbours below are tied to that one,
    which leaves hardly more edges than nodes where many tasks have found trees over the same nodes. Each round takes the smallest label among the neighbours in the edges as given, then follows labels of labels.
    Edges are never rewired, so no node gathers neighbours; labels that many nodes share occur only as keys of a
    plain join of two stored tables, which adaptive execution splits. Runs until nothing changes.
    """
    edges = edges.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    edges = scratch.through_table(edges, "edges")
    below = scratch.through_table(edges.groupBy("b").agg(F.min("a").alias("low")), "below")
    others = edges.join(below, "b").where("a <> low").selectExpr("low AS a", "a AS b").distinct()
    edges = below.selectExpr("low AS a", "b").unionByName(others)
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    both = scratch.through_table(both.distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS node", "least(a, m) AS label")
    labels = scratch.through_table(labels, "labels")
    while True:
        seen = both.join(labels.selectExpr("node AS b", "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        near = labels.join(seen.selectExpr("a AS node", "m"), "node").selectExpr(
            "node", "label AS old", "least(label, m) AS label"
        )
        near = scratch.through_table(near, "labels")
        jump = near.selectExpr("node AS label", "label AS far")
        far = near.join(jump, "label").selectExpr("node", "old", "least(label, far) AS label")
        labels = scratch.through_table(far, "labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.selectExpr("node", "label AS component")
        labels = labels.select("node", "label")


def forest(edges: np.ndarray) -> np.ndarray:
    """(root, node) of every node that is not the smallest of its component, for rows (a, b)."""
    nodes, ends = np.unique(edges, return_inverse=True)
    a, b = ends.reshape(-1, 2).T if len(edges) else (ends, ends)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # Roots are hooked to smaller labels, then labels of labels are followed to the end.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (further := new[new]).tobytes() != new.tobytes():
            new = further
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[label[child]], nodes[child]], 1)


def cells_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def count_batches(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The table as compressed blocks, without empty ones."""
    for block in range(0, len(counts), _BLOCK):
        part = counts[block : block + _BLOCK]
        if part.any():
            yield block // _BLOCK, pa.compress(part.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def add_counts(blocks: DataFrame) -> np.ndarray:
    """Sum of tables given as rows (block, counts): first in groups of blocks, then of each block."""
    groups = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    some = blocks.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    some = some.groupBy("block", "part").applyInArrow(_add, "block int, counts binary")
    rows = some.groupBy("block").applyInArrow(_add, "block int, counts binary").toArrow()
    total = np.zeros(1 << CELL_BITS, np.uint32)
    for block, packed in zip(rows["block"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        total[block * _BLOCK : (block + 1) * _BLOCK] = _unpack(packed)
    return total


def _unpack(packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=4 * _BLOCK, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint32)


def _add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, block = np.zeros(_BLOCK, np.uint64), 0
    for batch in group:
        block = batch["block"][0].as_py()
        for packed in batch["counts"]:
            total += _unpack(packed.as_py())
    total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
    packed = pa.compress(total.tobytes(), codec="zstd", asbytes=True)
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])


def cells_used(hashes: DataFrame, column: str) -> np.ndarray:
    """Which cells the hashes of a bigint column fall in, as a table of fixed size."""
    cell = F.shiftrightunsigned(F.col(column), 64 - CELL_BITS)
    used = hashes.select(cell.alias("cell"))

    def mark(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in stream:
            counts[batch.column(0).to_numpy()] = 1
        rows = list(count_batches(counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            ["block", "counts"],
        )

    return add_counts(used.mapInArrow(mark, "block int, counts binary")) > 0
