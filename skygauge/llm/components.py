"""Connected components by alternating large and small stars.

Every round links each node's larger neighbours, then its smaller ones, to the
least neighbour.  A round is two aggregations and joins over edges only; it is
written to the shared folder, so lineage does not grow and lost executors cost
one round.  Hubs are split by adaptive execution: the minimum is pre-aggregated
and the join back is an ordinary shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import stored


def _sum_of_hashes() -> Column:
    return F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") > F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of an edge; the component is its least node.

    Nodes may be of any type that Spark orders.  Loops and repeated edges change
    nothing; edges with a null end are ignored; no edges give no rows.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().distinct()
    state = stored(links, "edges", seen=_sum_of_hashes())
    nodes = state.table
    while state.rows:
        after = stored(_small_star(_large_star(state.table)), "stars", seen=_sum_of_hashes())
        same = (after.rows, after.measures["seen"]) == (state.rows, state.measures["seen"])
        if state.table is not nodes:
            state.release()
        state = after
        if same:
            break
    stars = state.table.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # A node that only has a loop is its own component.
    ends = nodes.select(F.col("a").alias("node")).union(nodes.select(F.col("b").alias("node"))).distinct()
    return ends.join(stars, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
