"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstats.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of the edges ``(a, b)``, ``root`` the
    smallest node of its component. Repeated edges, loops and an empty table are fine;
    edges with a null end are ignored.

    Each node hooks onto its smallest neighbour if that is smaller, chains of hooks
    are shortened by doubling, and the edges between what remains go into the next
    round. Every table is written: a lost executor repeats one step only, and joins
    read plain shuffles that adaptive execution can split for nodes with many edges.
    """
    table = stored(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    nodes = stored(table.select(F.col("a").alias("node")).union(table.select("b")).distinct(), "nodes")
    labels, rest = nodes.select("node", F.col("node").alias("root")), table.where("a != b")
    while rest.take(1):
        both = rest.union(rest.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).where("root < node")
        hooks = _shortened(stored(hooks, "hooks"))
        before = nodes, table, hooks
        labels = nodes = stored(_renamed(labels, "root", hooks), "labels")
        rest = table = stored(_renamed(_renamed(rest, "a", hooks), "b", hooks).where("a != b").distinct(), "edges")
        dropped(*before)
    dropped(table)
    return labels


def _renamed(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    names = hooks.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    found = df.join(names, F.col(column) == F.col("__node"), "left")
    return found.withColumn(column, F.coalesce("__root", column)).select(df.columns)


def _shortened(hooks: DataFrame) -> DataFrame:
    """Every node's hook leads to the end of its chain."""
    while True:
        further = stored(_renamed(hooks, "root", hooks), "hooks")
        moved = further.join(hooks, ["node", "root"], "left_anti").take(1)
        dropped(hooks)
        hooks = further
        if not moved:
            return hooks
