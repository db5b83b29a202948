"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewright.llm.common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of itself and its neighbours ``v``; pre-aggregated, so hubs are fine."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: neighbours move to the smallest node they see."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.join(_least_neighbour(both), F.col("u") == F.col("_u")).filter(F.col("v") > F.col("u"))
    down = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    # Here every edge points from the larger node u to a smaller one v.
    small = down.join(_least_neighbour(down), F.col("u") == F.col("_u"))
    moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        small.select("u", F.col("m").alias("v"))
    )
    return moved.filter("u <> v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another one.

    The component is its smallest node. Links with a null end and links of a node to
    itself are ignored; repeated links count once; without links there are no rows.
    Alternating star steps need a number of rounds that grows with the logarithm of
    the graph's size; each round is a stored table.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"), F.col(left), F.col(right))
    edges = edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v")))
    edges = stored(edges.select("u", "v").distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        edges = stored(_stars(edges), "links")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
