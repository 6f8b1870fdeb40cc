"""Exact running totals over a sort key, without a single-task window.

A window with ``ORDER BY`` and no ``PARTITION BY`` runs in one task.  Here the
key space is cut into ranges at approximate quantiles of the key (a list of at
most ``n_ranges`` doubles on the driver), the per-range totals (at most
``n_ranges`` rows) get their own tiny running sum, and that offset is
broadcast back and added to a window partitioned by range.  Every window task
holds one range of distinct keys; the result is exact.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


def _range_ids(df: DataFrame, key: str, n_ranges: int) -> DataFrame:
    probs = [i / n_ranges for i in range(1, n_ranges)]
    qs = df.approxQuantile(key, probs, 1.0 / (4 * n_ranges)) if probs else []
    splits = sorted({q for q in qs if q is not None and math.isfinite(q)})
    if not splits:
        return df.withColumn(RANGE, F.lit(0.0))
    bucketizer = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=key, outputCol=RANGE,
        handleInvalid="keep",  # NaN goes to an extra last range: NaN sorts last in Spark
    )
    return bucketizer.transform(df.withColumn(key, F.col(key).cast("double")))


def running_totals(
    per_key: DataFrame, key: str, value_cols, descending: bool = True,
    n_ranges: int | None = None, materialise: bool = True,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum in key order) and ``total_<v>``.

    ``per_key`` must hold one row per distinct non-null ``key``.  With
    ``materialise`` it is checkpointed first (reliable storage), so the
    quantile job and the final plan read the same rows and the upstream
    plan runs once.
    """
    spark = per_key.sparkSession
    if n_ranges is None:
        n_ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if materialise:
        from riskfold.session import shared_root

        shared_root(spark)
        per_key = per_key.checkpoint(eager=True)
    ranged = _range_ids(per_key, key, n_ranges)

    totals = ranged.groupBy(RANGE).agg(*[F.sum(v).alias(f"_rt_{v}") for v in value_cols])
    order = F.col(RANGE).desc() if descending else F.col(RANGE).asc()
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        RANGE,
        *[F.coalesce(F.sum(f"_rt_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
        *[F.sum(f"_rt_{v}").over(everything).alias(f"total_{v}") for v in value_cols],
    )
    korder = F.col(key).desc() if descending else F.col(key).asc()
    within = Window.partitionBy(RANGE).orderBy(korder).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(offsets), RANGE)
    return joined.select(
        *[c for c in per_key.columns],
        *[(F.col(f"_off_{v}") + F.sum(v).over(within)).alias(f"cum_{v}") for v in value_cols],
        *[F.col(f"total_{v}") for v in value_cols],
    )
