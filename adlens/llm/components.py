"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, few, tidy


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its neighbours (the larger or the smaller ones) to the
    least node around it. ``edges``: u, v, each pair once."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    around = few(both.join(least, "u"))
    if large:
        out = around.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = around.filter("v < u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            few(least).filter("m < u").select("u", F.col("m").alias("v")))
    return few(out.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether all that is left is stars: every larger end has one edge and
    is no other's least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("hub")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("hub")))
    at = few(ends.groupBy("node").agg((F.sum("out") + F.max("hub")).alias("roles")))
    return (at.agg(F.max("roles")).first()[0] or 1) == 1


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of ``edges`` (u, v,
    distinct ends). Rounds grow with the logarithm of the chains' length; the
    lineage is cut after each."""
    now = cut(few(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()))
    while not _settled(now):
        now = cut(_star(_star(now, True), False))
        tidy(now.sparkSession)
    # stars now: every node but the least points at it
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def extended(known: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of all links so far: those behind ``known`` (stars, each
    component's nodes to its least) and the further ``links``."""
    return components(known.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links.select("u", "v")))
