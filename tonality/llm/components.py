"""Connected components by contraction, as DataFrame joins over staged tables.

Each round hooks every node to its smallest neighbour, jumps the pointers until every
node points at the root of its tree, and replaces the edges by edges between roots; what
is left are edges between trees.  Nothing is gathered on the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _jumped(hooks: DataFrame) -> DataFrame:
    """(node, to) with ``to`` the root of the node's tree; pointers double each round."""
    while True:
        up = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = staged(hooks.join(up, "to").select(
            "node", F.col("next").alias("to"), (F.col("next") < F.col("to")).alias("moved")), "hooks")
        hooks = step.select("node", "to")
        if not step.where("moved").limit(1).count():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that occurs in ``edges`` (columns a, b: bigint) with the
    smallest node reachable from it.  Nulls and loops are left out."""
    spark = edges.sparkSession
    flat = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(
        "a < b")
    left = staged(flat.distinct(), "edges")
    labels = None
    while left.limit(1).count():
        hooks = (left.select(F.col("b").alias("node"), F.col("a").alias("to"))
                 .unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("to")))
                 .groupBy("node").agg(F.min("to").alias("to"))
                 .select("node", F.least("node", "to").alias("to")))
        hooks = _jumped(staged(hooks, "hooks"))
        if labels is None:
            labels = hooks.withColumnRenamed("to", "root")
        else:
            nxt = hooks.select(F.col("node").alias("root"), "to")
            labels = staged(labels.join(nxt, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")), "labels")
        low = hooks.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        high = hooks.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        pairs = left.join(low, "a").join(high, "b").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        left = staged(pairs.where("a < b").distinct(), "edges")
    if labels is None:
        return spark.createDataFrame([], "node bigint, root bigint")
    return labels


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after adding ``edges`` (a, b) between nodes of an earlier labelling."""
    if labels is None:
        return components(edges)
    at = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    bt = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    lifted = edges.join(at, "a", "left").join(bt, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    new = components(lifted)
    up = new.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = labels.join(up, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    fresh = new.join(labels.select("node"), "node", "left_anti")
    return staged(old.unionByName(fresh), "labels")
