"""Boosting that draws rows a round, on equal rows counted together: the same law, and no dependence on the layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfold import queries as Q
from riskfold.operators import draws, evaluate
from riskfold.plans import train as train_plan
from riskfold.plans.train import WEIGHT_COL
from riskfold.roles import Roles


def rows(spark, n=30_000, parts=4):
    """Numbers of few and of many values, nulls and NaN among them, and a label that follows them with noise."""
    df = spark.range(n, numPartitions=parts).selectExpr(
        "id", "IF(id % 11 = 0, NULL, CAST(id % 5 AS INT)) AS a",
        "IF(id % 13 = 0, CAST('NaN' AS DOUBLE), IF(id % 19 = 0, NULL, ((id * 7919) % 1009) / 8D)) AS b",
        "IF(id % 17 = 0, NULL, CAST(id % 3 AS STRING)) AS c",
        "CAST((id % 5) * 30 + (id * 7919) % 1009 / 8D + (id * 104729) % 97 > 150 AS INT) AS target")
    return df, Roles.of(df, id_cols=["id"], label_col="target", categorical=["c"])


@pytest.fixture
def pooling(monkeypatch):
    """Small tables are pooled too; sizes of what the rounds go over."""
    seen, boosted = [], draws.boosted
    monkeypatch.setattr(draws, "LEAST_ROWS", 1000)
    monkeypatch.setattr(draws, "boosted", lambda cells, trees: seen.append(cells.count()) or boosted(cells, trees))
    return seen


def test_rounds_go_over_cells_and_score_as_a_fit_of_all_rows(spark, pooling, monkeypatch):
    df, roles = rows(spark)
    options = dict(preset="notebook", id_col="id", maxIter=4, maxDepth=4)
    pooled = train_plan.fit(df, roles, **options)
    monkeypatch.setattr(draws, "LEAST_ROWS", 1 << 60)
    plain = train_plan.fit(df, roles, **options)
    assert len(pooling) == 1 and pooling[0] <= 2 * 6 * 32 * 4  # not a row for each of 24,000
    auc = []
    for t in (pooled, plain):
        gbt = t.model.stages[-1]
        assert gbt.getNumTrees == 4 and list(gbt.treeWeights) == [1.0] + [0.1] * 3 and gbt.getSubsamplingRate() == 0.8
        assert gbt.numFeatures == 3 and gbt.getLabelCol() == "target"
        auc.append(evaluate.auc_exact(train_plan.scored_rows(t.model, t.test, ["target"]), "target", "prob").first()["auc"])
    assert min(auc) > 0.85 and abs(auc[0] - auc[1]) < 0.01
    means = [t.model.transform(df).agg(F.avg(train_plan.probability_of_default())).first()[0] for t in (pooled, plain)]
    assert abs(means[0] - means[1]) < 0.01


def test_drawn_model_is_saved_and_loaded(spark, pooling, tmp_path):
    df, roles = rows(spark, 12_000)
    t = train_plan.fit(df, roles, preset="notebook", id_col="id", maxIter=3, checkpointInterval=2)
    again = train_plan.load(train_plan.save(t.model, str(tmp_path / "m")))
    assert pooling and train_plan.model_digest(again) == train_plan.model_digest(t.model)
    assert again.stages[-1].getMaxIter() == 3


def test_row_key_gives_the_same_trees_in_any_layout(spark, pooling):
    df, roles = rows(spark)
    fits = [train_plan.fit(df.repartition(k), roles, preset="notebook", id_col="id", row_key=["id"], num_partitions=5, maxIter=3, seed=s)
            for k, s in ((1, 3), (7, 3), (3, 4))]
    digests = [train_plan.model_digest(t.model) for t in fits]
    assert len(pooling) == 3 and digests[0] == digests[1] != digests[2]


def test_layouts_query_pools_its_rows(spark, pooling, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "LAYOUTS", (1, 4))
    spark.range(40_000, numPartitions=3).selectExpr(
        "id % 9000 AS l_orderkey", "id * 31 % 977 AS l_partkey", "id % 101 AS l_suppkey", "CAST(id % 3 + 1 AS INT) AS l_linenumber",
        "CAST(id * 13 % 7 * 8 + 1 AS DOUBLE) AS l_quantity", "900D + id * 7919 % 6 AS l_extendedprice", "(id * 17 % 2) * 0.06D AS l_discount",
        "0.01D AS l_tax", "IF(id % 2 = 0, 'A', 'N') AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP_NTZ '2001-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = Q.q_fit_layouts(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(1, True), (4, True)]
    assert len(pooling) == 2 and max(pooling) < 30_000


def test_a_cell_keeps_a_binomial_number_of_its_rows(spark):
    df = spark.range(4000, numPartitions=2).select(F.when(F.col("id") % 2 == 0, 1).otherwise(1000).alias("n")).persist()
    got = np.array([[r["n"], r["a"], r["b"]] for r in df.select("n", draws.kept("n", 0.8, 1, 2).alias("k")).selectExpr("n", "k[0] AS a", "k[1] AS b").collect()])
    one, many = got[got[:, 0] == 1], got[got[:, 0] == 1000]
    assert set(one[:, 1]) == {0, 1} and abs(one[:, 1].mean() - 0.8) < 0.04
    assert abs(many[:, 1].mean() - 800) < 2 and abs(many[:, 1].var() - 160) < 30
    assert abs(np.corrcoef(many[:, 1], many[:, 2])[0, 1]) < 0.1
    again = [df.select(draws.kept("n", 0.8, seed, 2)).collect() for seed in (1, 1, 2)]
    assert again[0] == again[1] != again[2]


def test_histogram_divides_what_holds_many_rows(spark):
    values = [0.0] * 50 + [1e12] + [1 + i / 1e6 for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    got = draws.histogram(df, "v", 0.0, 1e12, len(values), 64)
    assert sum(n for _, _, n in got) == len(values)
    assert all(hi < lo for (_, hi, _), (lo, _, _) in zip(got, got[1:]))
    assert all(n * 64 <= len(values) for lo, hi, n in got if hi > lo) and (0.0, 0.0, 50) in got


def test_few_rows_and_wide_grids_are_drawn_one_by_one(spark, pooling):
    df, roles = rows(spark, 2400)
    train_plan.fit(df, roles, preset="notebook", id_col="id", maxIter=2)  # a grid of 2 x 6 x 32 x 4 = 1536 cells
    assert len(pooling) == 1
    wide = df.select("id", "target", *[(F.sqrt(F.col("id") + i)).alias(f"f{i}") for i in range(4)])
    train_plan.fit(wide, Roles.of(wide, id_cols=["id"], label_col="target", categorical=[]), preset="notebook", id_col="id", maxIter=2)
    assert len(pooling) == 1


def test_cells_hold_all_rows(spark):
    df, roles = rows(spark, 5000)
    train = df.withColumn("target", F.col("target").cast("double")).withColumn(WEIGHT_COL, F.col("target") + 0.5)
    cells = draws.counted(train, 5000, roles, WEIGHT_COL, {"a": 2.0, "b": 63.0}, [4], 32)
    got = draws.dealt_cells(cells, 4).collect()
    assert sum(r[draws.COUNT] for r in got) == 5000
    assert {r["a"] for r in got} == {0.0, 1.0, 2.0, 3.0, 4.0} and len({r["b"] for r in got}) == 32
    assert 63.0 in {r["b"] for r in got}  # missing ones, which are frequent
