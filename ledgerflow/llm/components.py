"""Connected components by hooking and contraction, as DataFrame joins over narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise

#: Rows up to which a list of ids may be broadcast; beyond, joins are left to shuffle.
BROADCAST_ROWS = 100_000


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of edges (a, b); the component is its smallest node.

    In each round every node hooks onto its smallest neighbour, pointers are shortened twice, and edges are redrawn
    between what is left; the number of nodes at least halves, so the rounds grow with the logarithm of the edges."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = materialise(pairs, "edges")
    labels = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root"))
        # Most nodes of a star hook onto one: read from a table on both sides, the join can be split by Spark.
        hooks = materialise(hooks, "hooked")
        hooks = materialise(follow(follow(hooks, hooks, "root"), hooks, "root"), "hooks")
        labels = hooks if labels is None else materialise(follow(labels, hooks, "root"), "labels")
        ends = follow(follow(pairs, hooks, "a"), hooks, "b")
        pairs = materialise(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
        if pairs.isEmpty():
            return labels.select("node", F.col("root").alias("component"))


def follow(df: DataFrame, hooks: DataFrame, col: str) -> DataFrame:
    """df with col replaced by the root it hooks onto; without a hook it stays."""
    to = hooks.select(F.col("node").alias("h_node"), F.col("root").alias("h_root"))
    joined = df.join(to, df[col] == to.h_node, "left")
    return joined.select(*[F.coalesce("h_root", df[c]).alias(c) if c == col else df[c] for c in df.columns])


def join_ids(df: DataFrame, ids: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """Semi or anti join with a list of ids: broadcast if it was counted as small, else shuffled."""
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids, on, how)
