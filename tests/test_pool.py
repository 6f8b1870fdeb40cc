"""Boosting on pooled rows: the same scores, from at most as many rows as the grid of bins has cells."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskfold.operators.pool import centres, pooled
from riskfold.plans import train as train_plan
from riskfold.plans.train import FEATURES, WEIGHT_COL
from riskfold.roles import Roles


def rows(spark, n=9000):
    """Few values a feature, nulls and NaN among them, and a label that follows them with noise."""
    df = spark.range(n, numPartitions=4).selectExpr(
        "id", "IF(id % 11 = 0, NULL, CAST(id % 5 AS DOUBLE)) AS a", "IF(id % 13 = 0, CAST('NaN' AS DOUBLE), CAST(id % 7 AS DOUBLE)) AS b",
        "IF(id % 17 = 0, NULL, CAST(id % 3 AS STRING)) AS c", "CAST((id % 5) * 2 + id % 7 + (id * 7919) % 5 > 9 AS INT) AS target")
    return df, Roles.of(df, id_cols=["id"], label_col="target", categorical=["c"])


def test_pooled_fit_scores_as_the_fit_of_all_rows(spark):
    df, roles = rows(spark)
    train = df.withColumn("target", F.col("target").cast("double")).withColumn(WEIGHT_COL, F.col("target") + 0.5)
    fits = [train_plan.fit_pipeline(train, roles, "quick", pool=p, maxIter=4) for p in (True, False)]
    # trees may split a node whose rows all agree by the last bit of a sum, so scores are compared
    scores = [[r[0] for r in train_plan.scored_rows(m, train, ["id"]).orderBy("id").select("prob").collect()] for m in fits]
    assert np.allclose(*scores, rtol=0, atol=1e-9)
    assert len({round(s, 6) for s in scores[0]}) > 10
    ready = fits[1].transform(train).select(FEATURES, "target", WEIGHT_COL)
    cells = pooled(ready, FEATURES, "target", WEIGHT_COL, 3, 32)
    assert cells.count() < 6 * 8 * 4 * 2  # not a row for each of 9,000
    sums = [x.agg(F.sum(WEIGHT_COL)).first()[0] for x in (cells, ready)]
    assert sums[0] == pytest.approx(sums[1], rel=1e-12)


def test_fit_that_draws_rows_keeps_them(spark):
    df, roles = rows(spark, 2000)
    train = df.withColumn("target", F.col("target").cast("double")).withColumn(WEIGHT_COL, F.lit(1.0))
    options = dict(maxIter=3, subsamplingRate=0.5)
    a, b = (train_plan.model_digest(train_plan.fit_pipeline(train, roles, "quick", pool=p, **options)) for p in (True, False))
    assert a == b


def test_continuous_feature_goes_to_the_nearest_of_its_quantiles(spark):
    df = spark.range(20_000, numPartitions=3).select(
        (F.col("id") % 2).cast("double").alias("y"), F.lit(2.0).alias("w"),
        array_to_vector(F.array(F.when(F.col("id") % 4 == 0, 0.5).otherwise(F.sqrt(F.col("id"))))).alias("x"))
    got = pooled(df, "x", "y", "w", 1, 8).collect()
    values = sorted({r["x"][0] for r in got})
    assert len(values) == 8 and 0.5 in values and len(got) == 16
    x = np.array([0.5 if i % 4 == 0 else np.sqrt(i) for i in range(20_000)])
    splits = (np.array(values)[:-1] + np.array(values)[1:]) / 2
    want = np.bincount(np.searchsorted(splits, x, side="left")) * 2.0  # a value at a split goes to the left
    weight = {v: sum(r["w"] for r in got if r["x"][0] == v) for v in values}
    assert [weight[v] for v in values] == want.tolist()


def test_rows_that_the_grid_does_not_merge_are_not_pooled(spark):
    df = spark.range(300).select(
        (F.col("id") % 2).cast("double").alias("y"), F.lit(1.0).alias("w"),
        array_to_vector(F.array(*[F.sqrt(F.col("id") + i) for i in range(40)])).alias("x"))
    assert pooled(df, "x", "y", "w", 40, 32) is None
    assert pooled(df.limit(0), "x", "y", "w", 40, 32) is None


def test_centres_keep_frequent_values():
    assert centres([1.0] * 5 + [2.0], 4) == [1.0, 2.0]
    got = centres([7.0] * 32 + [float(i) / 100 for i in range(32)], 8)
    assert 7.0 in got and len(got) == 8
