"""Connected components of an edge table, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import release, stash


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's larger neighbours (``large``) or its smaller ones and itself are linked to the
    smallest node around it."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    moved = joined.where(F.col("v") > F.col("u")) if large else joined
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(k, c): the smallest key of the component of each node of the edges (u, v), longs; loops and
    repeated edges are allowed, nodes without an edge to another node do not appear. Large-star and
    small-star rounds go on until nothing changes, a number that grows with the logarithm of the
    size; the table of a round is deleted when the next one is written."""
    edges = stash(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
                  "edges")
    before, settled = None, False
    while not settled:
        old, edges = edges, stash(_star(_star(edges, True), False), "edges")
        release(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        before, settled = now, now == before
    return edges.select(F.col("u").alias("k"), F.col("v").alias("c")).union(
        edges.select(F.col("v").alias("k"), F.col("v").alias("c"))).distinct()
