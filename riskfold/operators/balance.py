"""Class distribution and class weights.

Counting per class is a grouped count with map-side partial aggregation:
each task ships at most one row per class, so a class holding most rows
costs nothing extra.  The per-class result is bounded by the number of
classes and is the only thing that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    return (
        df.where(F.col(label_col).isNotNull())
        .groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    )


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """``(label, n, percentage)`` ordered by label; the total is a window over the tiny result."""
    counts = class_counts(df, label_col)
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percentage", F.col("n") / total * 100).orderBy(label_col)


def _weight(method: str, total: Column, n: Column, k: Column) -> Column:
    if method == "inverse":
        return total / n
    if method == "balanced":
        return total / (k * n)
    raise ValueError(f"unknown weighting {method!r}")


def class_weights_frame(df: DataFrame, label_col: str, method: str = "balanced") -> DataFrame:
    """``(label, n, weight)``: inverse = total/n, balanced = total/(k*n) for k classes."""
    counts = class_counts(df, label_col)
    w = Window.partitionBy()
    return counts.withColumn(
        "weight", _weight(method, F.sum("n").over(w), F.col("n"), F.count(F.lit(1)).over(w))
    )


def class_weights(df: DataFrame, label_col: str, method: str = "balanced") -> dict:
    """Weights of the binary label's classes as a dict; other label values are an error.

    One aggregate counts the two classes and checks the contract.
    """
    y = F.col(label_col)
    r = df.agg(
        F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"), F.count_if(~y.isin(0, 1)).alias("other")
    ).first()
    if r["other"]:
        raise ValueError(f"{label_col} must be 0 or 1; {r['other']} rows have other values")
    counts = {k: n for k, n in ((0.0, r["n0"]), (1.0, r["n1"])) if n}
    total, k = sum(counts.values()), len(counts)
    if method == "inverse":
        return {label: total / n for label, n in counts.items()}
    if method == "balanced":
        return {label: total / (k * n) for label, n in counts.items()}
    raise ValueError(f"unknown weighting {method!r}")


def with_class_weight(df: DataFrame, label_col: str, weights: dict, out: str = "class_weight",
                      default: float = 1.0) -> DataFrame:
    """Attach a weight per row from a literal ``CASE`` (no join); unknown class -> default."""
    expr = None
    for label, weight in sorted(weights.items()):
        cond = F.col(label_col) == F.lit(label)
        expr = F.when(cond, F.lit(weight)) if expr is None else expr.when(cond, F.lit(weight))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out, expr.cast("double"))
