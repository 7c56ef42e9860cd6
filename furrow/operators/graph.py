"""Connected components: of arrays inside a task, of edge tables across the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import drop_staged, stage


def components(pairs_a: np.ndarray, pairs_b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex of each vertex's component: hooking and pointer jumping on arrays."""
    label = np.arange(n)
    a, b = pairs_a, pairs_b
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label = up
    return label


def contract(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each component of the edges (u, v), for nodes other than the root.

    Alternating large-star and small-star steps; each round is staged in the shared folder and
    ends when a round changes nothing. Minima are aggregated before the shuffle and joined back, so
    a node with very many edges is never gathered in one task.
    """
    edges = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or tuple(state) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        new = stage(small, "edges")
        drop_staged(edges)
        edges = new
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")
