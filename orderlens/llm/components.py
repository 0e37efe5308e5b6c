"""Connected components of a link graph that never leaves the executors.

``components`` alternates large-star and small-star steps (each node points its larger, then its
smaller neighbours at the smallest id around it). Every step is one aggregation with a map-side
partial step and one join; hubs are spread by the join's skew handling. Each round is written
to the shared checkpoint folder, so a lost executor repeats at most one round. The driver sees
only a count and a checksum for each round.

``contract`` shrinks a task's own links to a star forest before they are shuffled, so a dense
group gives no more rows than it has nodes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import cut_lineage

MAX_ROUNDS = 60
PART_ROWS = 500_000  # links in one checkpoint file, so that a small graph is not spread over many


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) for the nodes that links (a, b) join; roots left out."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(hop := new[new], new):
            new = hop
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node that has a link, with the smallest node reachable.

    ``edges`` has long columns u and v. Links from a node to itself, repeated links, links with a
    null end and an empty table are allowed; nodes without a link to another node are left out.
    """
    star = edges.select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    ).where("u <> v")
    star = cut_lineage(star.distinct())
    state = _state(star)
    for _ in range(MAX_ROUNDS):
        # large star: neighbours greater than a node point to the smallest of its neighbourhood
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: smaller neighbours and the node itself point to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        star = cut_lineage(small.coalesce(max(1, -(-state[0] // PART_ROWS))))
        now = _state(star)
        if now == state:
            return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
