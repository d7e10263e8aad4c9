"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them: the larger ones, or the others."""
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
    least = pairs.groupBy("a").agg(F.min("b").alias("_least")).select(
        F.col("a").alias("_of"), F.least("a", "_least").alias("_least")
    )
    linked = pairs.join(least, F.col("a") == F.col("_of"))
    if large:
        linked = linked.where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("_least").alias("b")
        )
    else:
        linked = linked.select(F.col("b").alias("a"), F.col("_least").alias("b")).unionByName(
            least.select(F.col("_of").alias("a"), F.col("_least").alias("b"))
        )
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node, component`` for every node of the edges ``a, b`` (longs, not NULL).

    A component's number is its smallest node. Large and small stars alternate
    until every node hangs on its component's smallest node; the number of
    rounds grows with the logarithm of the longest path. Each round's edges are
    written to the shared folder, so lineage stays short. Only the counts that
    tell whether a round changed anything come to the driver.
    """
    edges = store(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges",
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = store(_star(_star(edges, large=True), large=False), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
