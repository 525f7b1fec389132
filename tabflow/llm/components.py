"""Connected components: within a task with numpy, across tasks by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed


def roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest node reachable from each of n nodes over the links (a, b)."""
    label = np.arange(n) if label is None else label
    while True:
        x, y = label[a], label[b]
        if np.array_equal(x, y):
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as (u, v): every node with the least of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = roots(len(nodes), at[:len(u)], at[len(u):])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v): root is the least node reachable.

    Alternates large and small stars until the links stand still, some log n rounds. A
    hub's links are never gathered: its least neighbour is a partial aggregate and comes
    back by a join, whose hot side AQE splits. Each round ends in a checkpoint. No links
    give no rows; repeated links and links of a node with itself change nothing.
    """
    u, v = F.col("u"), F.col("v")
    now = checkpointed(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct("u", "m"), F.struct(v.alias("u"), "m"))
        small = large.join(least, "u").select(F.explode(pairs).alias("p")).select("p.u", F.col("p.m").alias("v"))
        now = checkpointed(small.where(u != v).distinct())
    root = now.select(u.alias("node"), v.alias("root"))
    return root.unionByName(now.select(v.alias("node"), v.alias("root")).distinct())
