"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
    )).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour or itself."""
    arcs = _both_ways(edges)
    smallest = arcs.groupBy("u").agg(F.min("v").alias("least")).select(
        "u", F.least("u", "least").alias("low")
    )
    return arcs.where("v > u").join(smallest, "u").select(F.col("low").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of a node, and the node, on the smallest of them."""
    arcs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    smallest = arcs.groupBy("u").agg(F.min("v").alias("low"))
    moved = arcs.join(smallest, "u").where("v <> low").select(F.col("low").alias("a"), F.col("v").alias("b"))
    return moved.unionAll(smallest.select(F.col("low").alias("a"), F.col("u").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node.

    Only two numbers reach the driver per round. Neighbours are never gathered: a hub's rows
    meet one row with its smallest neighbour in a join that Spark can split. The number of
    rounds is logarithmic in the size of a component.
    """
    now = cut_lineage(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct())
    before, state = None, _state(now)
    while state != before:
        now = cut_lineage(_small_star(_large_star(now)).distinct())
        before, state = state, _state(now)
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return members.unionAll(roots)
