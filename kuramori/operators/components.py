"""Connected components of an undirected graph by alternating large-star and small-star rounds.

Only edges are held, never a component: a component of any size is spread over the cluster, and each round
shrinks every path to a star. Nothing is collected to the driver but two numbers per round (the convergence check)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuramori.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; the component is the least node in it.

    Self loops name their node; null ends are dropped; repeated edges count once; no edges give no rows."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null").distinct()
    e = cut(e)
    loops = e.filter("u = v").select(F.col("u").alias("node"))
    e, before = e.filter("u <> v"), None
    for _ in range(max_rounds):
        e = cut(_small_star(_large_star(e)))
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = members.union(roots)
    alone = loops.join(found.select("node"), "node", "left_anti").distinct()
    return found.union(alone.select("node", F.col("node").alias("component")))
