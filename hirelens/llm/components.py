"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import store

ROUNDS = 1000


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of the edges (columns a, b, both bigint); equal labels are connected.

    Each round draws an order of the nodes anew. A node takes the least of itself and its neighbours, then the least
    of what its neighbours have taken, so a star is one node after one round and a chain shrinks by a factor however
    it is numbered. The edges are relabelled and stored. Empty edges give an empty result.
    """
    edges = store(edges.where("a <> b").distinct(), "edges")
    labels = None
    for turn in range(ROUNDS + 1):
        if edges.isEmpty():
            break
        if turn == ROUNDS:
            raise RuntimeError(f"the edges are not contracted after {ROUNDS} rounds")
        ends = edges.union(edges.select("b", "a"))
        placed = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("v"))
        near = ends.groupBy("a").agg(F.min(placed("b")).alias("other"))
        near = store(near.select(F.col("a").alias("node"), F.least(placed("a"), "other").alias("taken")), "near")
        second = ends.join(near, ends["b"] == near["node"]).groupBy("a").agg(F.min("taken").alias("other"))
        hooks = near.join(second, near["node"] == second["a"])
        hooks = store(hooks.select("node", F.least("taken", "other")["v"].alias("label")), "hooks")
        labels = hooks if labels is None else store(_followed(labels, hooks), "labels")
        edges = store(_relabelled(edges, hooks), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _followed(labels: DataFrame, step: DataFrame) -> DataFrame:
    """Labels after a step that gives some of them another label."""
    step = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))


def _relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between labels; a node without one is its own."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    named = edges.join(a, "a", "left").join(b, "b", "left")
    named = named.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    return named.where("a <> b").distinct()


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels of :func:`connected` after more edges, which may bring nodes of their own."""
    step = connected(_relabelled(edges, labels))
    fresh = step.join(labels.select("node"), "node", "left_anti")
    fresh = fresh.join(labels.select(F.col("label").alias("node")).distinct(), "node", "left_anti")
    return store(_followed(labels, step).unionByName(fresh), "labels")
