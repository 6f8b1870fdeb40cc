"""Connected components of links between rows, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` of every linked node: the smallest node that its links reach.

    ``links`` has columns ``a`` and ``b``.  Large-star hangs a node's larger
    neighbours under its smallest one, small-star the smaller ones; both are a
    minimum by node (summed up before the shuffle) and a join, so a hub with
    very many links is split like any skewed join.  The rounds needed grow
    with the logarithm of the longest path.  Self-links are ignored.
    """
    edges = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), label)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        edges = written(small.where("a <> b").distinct(), label)
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
