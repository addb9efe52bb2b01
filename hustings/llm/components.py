"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round replaces the edges by edges to smaller neighbours, until the edges
are stars around the smallest node of each component (Kiveris et al., "Connected
Components in MapReduce and Beyond"). Rounds exchange edges only, are written to
the shared folder, and grow with the logarithm of the longest path. A node with
very many neighbours is one value of a partial minimum and one key of a join
that Spark splits when it is skewed, for which the minima are dealt anew: it
splits no join that takes a grouping as it lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm._spark import drop_table, stage_table


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the minimum m of their u; those of one u may go to several tasks."""
    return edges.join(least.repartition(F.xxhash64("u")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _with_least(both.where("v > u"), least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(down, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """node, component: the smallest node that each node of the edges reaches, nodes that are their own component included."""
    pairs = edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    current = stage_table(pairs)
    state = _state(current)
    while state[0]:
        star = stage_table(_small_star(_large_star(current)))
        after = _state(star)
        drop_table(current)
        current = star
        if after == state:
            break
        state = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
