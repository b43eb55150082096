"""Connected components of an edge table by alternating star steps.

Every step is a partial aggregation and a join, and its edges are written to
the shared scratch folder, so lineage stays short and no node's neighbours,
links or components are ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them.

    Large step: neighbours above the node; small step: those below it, and
    the node itself. Edges are (a, b) with a > b.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(turned) if large else edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    hung = near.join(least, "a")
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.filter("a > b").distinct()


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(id, component) of every node that has an edge; the component is its least id.

    ``edges`` has two id columns ``a`` and ``b``; loops and repeats are ignored.
    """
    current = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a > b").distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
        return row["n"], row["h"]

    before = mark(current)
    for _ in range(max_steps):
        if before[0] == 0:
            break
        current = saved(_star(_star(current, True), False), "edges")
        now = mark(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    nodes = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("id"), "component").distinct())
