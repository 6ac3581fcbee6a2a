"""Connected components of a graph that no machine holds: alternating large-star and small-star steps.

An edge list is turned into stars around each component's smallest node. A large-star step hangs the larger
neighbours of every node on its smallest neighbour; a small-star step does the same with the smaller ones. Both are a
minimum per node, which is summed before it is shuffled, and a join back in which hubs are broadcast (see skew_join).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, skew_join, written

#: Edges that a task contracts at a time before the first step.
CONTRACT_EDGES = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes of these edges that aren't roots; a root is its component's smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(edges: DataFrame) -> DataFrame:
    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= CONTRACT_EDGES:
                yield contract(held)
                held, count = [], 0
        if held:
            yield contract(held)

    def contract(held):
        a, b = (np.concatenate([x[c].to_numpy() for x in held]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """One step over edges (a > b)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        joined = skew_join(both, least, ["a"], "n", 2 * total).filter(F.col("b") > F.col("a"))
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        joined = skew_join(edges, least, ["a"], "n", total)
        out = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, name: str = "components", keep: Scratch | None = None) -> DataFrame:
    """(node, label) of every node of the edges (a, b) that isn't its component's smallest; label is the smallest.

    The result is a written table, in `keep` if given.
    """
    ordered = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    with Scratch(edges.sparkSession) as tmp:
        now = tmp.written(_contracted(ordered).distinct(), "edges")
        while True:
            # stars: no node is both a leaf and a hub, and every leaf has one hub
            total, leaves = now.agg(F.count("*"), F.count_distinct("a")).first()
            if total == leaves and now.select(F.col("b").alias("a")).join(now, "a", "left_semi").isEmpty():
                return (keep.written if keep else written)(now.select(F.col("a").alias("node"), F.col("b").alias("label")), name)
            now = tmp.written(_star(now, total, large=True), "edges")
            now = tmp.written(_star(now, now.count(), large=False), "edges")
