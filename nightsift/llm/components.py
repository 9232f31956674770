"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def stars(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (a, b): each node but the smallest of its component, with that smallest one.

    Each round links the larger neighbours of a node, then the smaller ones, to the least among them; it ends when the
    table stays as it was, after about as many rounds as the logarithm of the longest chain. Minima are pre-aggregated
    and joined back, so a node with very many edges is never gathered.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sign = None
    while True:
        new = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if new == sign or not new[0]:
            return e
        sign = new
        both = e.union(e.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = materialize(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(moved.union(low).distinct(), "small")
