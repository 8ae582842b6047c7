"""Connected components of a link table, as Spark joins and partial aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (node, root) of the graph with links ``a[i] - b[i]``; root is the least node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[:len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the least node reachable.

    Every round lowers a node's label to the least label among its neighbours
    (a partial aggregate, so a node with millions of links is pre-aggregated
    before the shuffle) and then follows the label once (pointer jumping).
    State lives in checkpoints in the shared folder; only a count of changed
    labels reaches the driver.  Empty input: an empty table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut(both.where("a <> b").distinct())
    label = cut(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                .select("node", F.least("node", "m").alias("root")))
    for _ in range(max_rounds):
        near = (edges.join(label.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        low = label.join(near, "node", "left").select(
            "node", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        up = label.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = cut(low.join(up, "root", "left").select(
            "node", "was", F.least("root", "above").alias("root")))
        changed = step.where("was <> root").limit(1).count()
        label = step.select("node", "root")
        if not changed:
            return label
    raise RuntimeError("components: no end after max_rounds")
