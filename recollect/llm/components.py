"""Connected components by alternating large and small stars, as DataFrames.

Every round hooks each node's larger neighbours to its smallest neighbour, then its smaller ones; the edges
end as stars around the smallest node of each component. A round is two aggregations and joins; nothing is
collected but a count and a checksum. Once the edges that are left are counted to be few (16 bytes each), one task on an
executor finishes them, which gives the same components without the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.runtime import release, small_side, stage, tidied

#: Nodes with their smallest neighbour (16 bytes each) broadcast at most; more are joined by shuffle, where Spark splits a hub's many edges.
BROADCAST_ROWS = 200_000
#: Edges that one task takes at most (16 MiB).
TASK_EDGES = 1 << 20


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _in_one_task(edges: DataFrame) -> DataFrame:
    """node, component from a counted number of edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        label = np.arange(len(nodes))
        while True:  # labels are places of nodes in ascending order, so the least label is the smallest node
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])

    return edges.select("u", "v").repartition(1).mapInArrow(tidied(run), "node long, component long")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, component (smallest node reachable) of every node of ``edges`` (u, v: long)."""
    now = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    mark = _mark(now)
    while mark[0] > TASK_EDGES:
        # large star: u > v; every neighbour larger than a node goes to the node's smallest neighbour
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = both.where("v > u").join(small_side(least, BROADCAST_ROWS), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: every smaller neighbour, and the node itself, goes to the smallest
        down = stage(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
        lower = stage(down.groupBy("u").agg(F.min("v").alias("m")), label)
        small = down.join(small_side(lower, BROADCAST_ROWS), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(lower.select("u", F.col("m").alias("v")))
        old, now = now, stage(small.distinct(), label)
        release(old, least, down, lower)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    if mark[0] <= TASK_EDGES:
        return _in_one_task(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
