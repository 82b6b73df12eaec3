"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import drop_written, written


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as connect what the edges (a, b) connect: each node with its group's least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new[label]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One pass. The minima are written before the join, so that both of its sides are plain
    shuffles, of which a hub's rows can be split."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "star")
    if large:  # edges in both directions: larger neighbours go to the least of all
        joined = edges.join(least.withColumn("m", F.least("u", "m")), "u")
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    joined = edges.join(least, "u")  # edges from larger to smaller: all go to the least
    return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id on an edge between different ids; the component is its least id.

    Large and small stars alternate until nothing changes, which takes a few passes that grow with
    the logarithm of a component's length. Edges with a null end are left out; no edges give an
    empty result. Every pass is a table in the shared folder.
    """
    edges = edges.where(F.col(a) != F.col(b))  # not true for nulls
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(edges.distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_stars(both, large=True).distinct(), "large")
        new = written(_stars(large, large=False).distinct(), "edges")
        state = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        drop_written(large)
        drop_written(edges)
        edges = new
        if state == before:
            break
        before = state
    least = edges.select("v").distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        least.select(F.col("v").alias("id"), F.col("v").alias("component"))
    )
