"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.tables import map_batches, stored


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of a list of edges, roots left out."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _thinned(edges: DataFrame) -> DataFrame:
    """Each batch's edges as stars around the smallest node; the reach of the edges stays the same."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, root = spanning(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return map_batches(edges.select("a", "b"), stars, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node on an edge; edges are (a bigint, b bigint), both not null.

    Each round first ties the larger neighbours of a node to its smallest one, then the smaller ones, and ends
    when no edge moved. The number of rounds grows with the logarithm of the longest chain. Every step is a
    grouping or a join, so a node with very many edges is counted before the shuffle and split by the optimizer.
    """
    now = stored(_thinned(edges).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = large.join(least, "a")
        small = tied.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b"))).distinct()
        new = stored(small, "edges")
        # Stars are stable: all edges are the same as before.
        sums = [frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first() for frame in (now, new)]
        now = new
        if sums[0] == sums[1]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
