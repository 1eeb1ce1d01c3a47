"""Connected components of an undirected graph by alternating star contraction.

Each round rewires edges to smaller neighbours, first from every node to its larger
neighbours, then from every node to its smaller ones; when nothing changes the edges are
stars around the smallest node of each component (large-star / small-star). A round is two
pairs of a grouped minimum, combined before its shuffle, and a join of edges with it. The job
that tells whether a round changed anything also finds nodes with a large share of the
edges; their edges are dealt over salted buckets of the join, each of which gets a copy of the
node's minimum. No node's neighbours are ever gathered.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, functions as F

from lendstrata.operators.skew import HotKeys, hot_keys, skew_join

from .common import discard, stage_at

#: A node is a hub from this share of the edges on; so many counters find them all.
HUB_SHARE = 1 / 256
_COUNTERS = 2 ** ceil(log2(4 / HUB_SHARE))


def _star(edges: DataFrame, large: bool, hubs: HotKeys) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    lowest = lowest.select("a", F.least("a", "low").alias("low"))
    linked = skew_join(both, lowest, ["a"], hot_left=hubs, hot_right={})
    if large:
        moved = linked.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        # every smaller neighbour hangs below the smallest, and so does the node itself
        moved = linked.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select("a", F.col("low").alias("b"))
        )
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple[tuple, HotKeys]:
    """Number and checksum of the edges, and the hubs with their share of the ends: at most
    two for each part of ``HUB_SHARE``."""
    top = [
        F.call_function("approx_top_k", F.xxhash64(c), F.lit(ceil(1 / HUB_SHARE)), F.lit(_COUNTERS)).alias(c) for c in "ab"
    ]
    n, checksum, *ends = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), *top).first()
    counts: dict[int, int] = {}
    for found in ends:
        for t in found or ():
            counts[t["item"]] = counts.get(t["item"], 0) + t["count"]
    hubs = {key: count / (2 * n) for key, count in counts.items() if count >= HUB_SHARE * 2 * n}
    return (n, checksum), hubs


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(a, b)`` links of long ids to ``(node, component)``: the smallest id reachable.

    Rows that link a node with itself or have a NULL end, and repeated links, change nothing;
    only nodes with a link to another node are returned; no links give no rows.
    """
    spark = edges.sparkSession
    now, path = stage_at(edges.where("a <> b").select("a", "b").distinct(), f"{label}-links")
    before = None
    while True:
        state, hubs = _state(now)
        if state == before or state[0] == 0:
            break
        before = state
        following, new_path = stage_at(_star(_star(now, True, hubs), False, hubs), f"{label}-links")
        discard(spark, path)
        now, path = following, new_path
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def lowest_of(members: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``members`` with the least ``value`` of their ``key``; a key with a large share of the rows
    is dealt over salted buckets. ``members`` should be a stored table."""
    lowest = members.groupBy(key).agg(F.min(value).alias(out))
    (hot,) = hot_keys(members, [key])
    return skew_join(members, lowest, [key], hot_left=hot, hot_right={})
