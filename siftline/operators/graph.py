"""Connected components by contraction to stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators.order import cut

EDGES_PER_PART = 50_000


def _to_least(pairs: DataFrame) -> DataFrame:
    """a, b of pairs with the least of a and all its b."""
    least = pairs.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("low")).select("k", F.least("k", "low").alias("low"))
    return pairs.join(least, pairs["a"] == least["k"]).select("a", "b", "low")


def labels(edges: DataFrame, most_rounds: int = 64, after_round: Callable[[], None] = lambda: None) -> DataFrame:
    """node, label for every node of edges (a, b) between different nodes: the smallest node that it reaches.

    A round hangs every node's larger neighbours on its least one, then its smaller ones; the rounds grow with the
    logarithm of the nodes (Kiveris and others, "Connected Components in MapReduce and Beyond"). Minima are merged before
    they are shuffled, so a node with very many neighbours costs one row for each map task, and each round is
    checkpointed. Fails rather than return labels that aren't final. No edges, no rows.
    """
    links = cut(edges.where("a <> b").select("a", "b").distinct())
    before = None
    for _ in range(most_rounds):
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before, parts = now, -(-now[0] // EDGES_PER_PART)  # few files and tasks for a small graph, all there are for a large one
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(parts)
        large = _to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        small = _to_least(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(small.select("a", F.col("low").alias("b")))
        links = cut(small.where("a <> b").distinct().coalesce(parts))
        after_round()
    else:
        raise RuntimeError(f"components not final after {most_rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


def connected(nodes: DataFrame, edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """node, component for every node: the smallest node that it reaches. nodes: node; edges: a, b."""
    found = labels(edges, most_rounds)
    return nodes.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("label", "node").alias("component"))
