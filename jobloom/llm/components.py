"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import written


def _toward_minimum(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) with the smallest of u and all its v as ``m``; sums combine before the shuffle, so a hub is no hot group."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    arcs = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _toward_minimum(arcs).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    arcs = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
    tied = _toward_minimum(arcs)
    own = tied.select(F.col("m").alias("a"), F.col("u").alias("b"))
    rest = tied.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return own.union(rest).distinct()


def components(pairs: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(``node``, ``component``) for each node of ``pairs``; the component is its least node.

    Pairs of a node with itself and pairs with a null are ignored.  Rounds go on until the pairs no longer change: each
    round ties nodes to smaller ones only, so they settle, after a few rounds even for long chains.  Each round is
    written to the shared folder, so no lineage grows; only a count and a sum of hashes reach the driver.
    """
    a, b = F.col(left), F.col(right)
    now = written(
        pairs.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "components"
    )
    before, mark = None, _mark(now)
    while mark != before:
        now = written(_small_star(_large_star(now)), "components")
        before, mark = mark, _mark(now)
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    heads = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return members.union(heads)


def _mark(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s
