"""Hand-made edge inputs (FIXTURES.md §5) and brute-force checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskfold.functions.scoring import risk_level, threshold_label
from riskfold.operators import balance, clean, evaluate, prep
from riskfold.operators.prefix import running_totals
from riskfold.roles import Roles
from riskfold.sources.requests import REQUEST_SCHEMA, request_columns, split_requests


def test_all_missing_filter(spark):
    df = spark.createDataFrame(
        [(1.0, None, None), (None, None, None), (float("nan"), None, None), (None, 3, None), (None, None, "x")],
        "a double, b int, c string",
    )
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=("c",))
    assert clean.drop_all_missing_rows(df, roles).count() == 3


def test_no_features_keeps_all(spark):
    df = spark.createDataFrame([("x",), (None,)], "id string")
    roles = Roles.of(df, id_cols=("id",), label_col=None, categorical=())
    assert clean.drop_all_missing_rows(df, roles).count() == 2


def test_rate_exactly_threshold_is_kept(spark):
    rows = [(None,)] * 19 + [(1.0,)]
    df = spark.createDataFrame(rows, "a double").withColumn("b", F.lit(1.0))
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=())
    dropped, n = clean.sparse_columns(df, roles, 0.95)
    assert n == 20 and dropped == []


def test_empty_table_drops_nothing(spark):
    df = spark.createDataFrame([], "a double, c string")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=("c",))
    c = clean.clean(df, roles)
    assert c.dropped == [] and c.n_rows == 0


def test_roles_refresh_after_drop(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 0)], "customer_ID long, x double, B_30 string, target int")
    roles = Roles.of(df)
    assert roles.categorical == ("B_30",) and roles.numeric == ("x",)
    r2 = roles.refresh(df.drop("B_30").schema)
    assert r2.categorical == () and r2.features == ("x",)


def test_index_ties_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=("k",))
    # NULL becomes the 'missing' category; test unseen with handleInvalid=keep on new data
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[prep.cast_stage(roles), prep.indexer_stage(roles)]).fit(
        df.where(F.col("k").isNotNull())
    )
    out = {r["k"]: r["k_idx"] for r in model.transform(df).collect()}
    assert out == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}


def test_integer_code_and_text_index_alike(spark):
    df = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=("k",))
    out = prep.string_index(df, roles, keep=[]).collect()
    assert {(r["k"], r["k_idx"]) for r in out} == {("2", 0.0), ("3", 1.0)}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=())
    out = prep.standard_scale(df, roles, keep=[]).collect()
    assert [r["a_z"] for r in out] == [0.0, 0.0]
    assert sorted(r["b_z"] for r in out) == pytest.approx([-1 / math.sqrt(2), 1 / math.sqrt(2)])


def test_imputer_handles_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "a double")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=())
    assert [r["a"] for r in prep.impute_mean(df, roles, keep=[]).collect()] == [1.0, 3.0, 2.0, 2.0]


ROC_TIES = [(1, .9), (1, .8), (0, .8), (1, .4), (0, .3), (0, .3), (1, .3), (0, .1)]


@pytest.mark.parametrize("n_ranges", [1, 2, 3, 8])
def test_auc_with_ties(spark, n_ranges):
    df = spark.createDataFrame(ROC_TIES, "target int, prob double")
    assert evaluate.auc_exact(df, n_ranges=n_ranges).first()["auc"] == pytest.approx(0.78125)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, .2), (1, .7)], "target int, prob double")
    assert evaluate.auc_exact(df).first()["auc"] is None


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_running_totals_brute_force(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(0, 1), round(rng.random() ** 2, 2)) for _ in range(600)]
    pairs += [(1, 0.5)] * 200  # a hot score holding a quarter of the rows
    df = spark.createDataFrame(pairs, "target int, prob double")
    for n_ranges in (1, 5, 16):
        roc = {r["score"]: r for r in evaluate.roc_curve(df, n_ranges=n_ranges).collect()}
        for s, r in roc.items():
            assert r["tp"] == sum(1 for y, p in pairs if y == 1 and p >= s)
            assert r["fp"] == sum(1 for y, p in pairs if y == 0 and p >= s)
        assert evaluate.auc_exact(df, n_ranges=n_ranges).first()["auc"] == pytest.approx(_brute_auc(pairs))


def test_running_totals_ascending(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(50)], "k double, v long")
    out = running_totals(df, "k", ["v"], descending=False, n_ranges=4).orderBy("k").collect()
    assert [r["cum_v"] for r in out] == [sum(range(i + 1)) for i in range(50)]
    assert {r["total_v"] for r in out} == {sum(range(50))}


def test_risk_and_threshold_boundaries(spark):
    df = spark.createDataFrame([(0.2999,), (0.3,), (0.5,), (0.6999,), (0.7,), (None,)], "p double")
    out = df.select("p", risk_level("p").alias("r"), threshold_label("p").alias("t")).collect()
    assert [(r["r"], r["t"]) for r in out] == [
        ("low", 0), ("medium", 0), ("medium", 1), ("medium", 1), ("high", 1), (None, None)]


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "target int, prob double")
    m = evaluate.classification_metrics(df).first()
    assert m["precision"] == 0.0 and m["f1_score"] == 0.0 and m["recall"] == 0.0


def test_missing_class_weight_defaults_to_one(spark):
    df = spark.createDataFrame([(0,), (0,), (None,)], "target int")
    w = balance.class_weights(df, "target", "balanced")
    out = balance.with_class_weight(df.union(spark.createDataFrame([(1,)], "target int")), "target", w)
    got = {r["target"]: r["class_weight"] for r in out.collect()}
    assert w == {0.0: 1.0} and got[1] == 1.0 and got[0] == 1.0
    both = balance.class_weights(spark.createDataFrame([(0,), (0,), (1,)], "target int"), "target", "inverse")
    assert both == {0.0: 1.5, 1.0: 3.0}


def test_requests(spark):
    rows = [
        ("c1", {}),
        ("c2", {"a": "2", "x": "1.5", "zz": "ignored"}),
        ("c3", {"a": "text", "k": "K"}),
        ("c4", None),
    ]
    df = spark.createDataFrame(rows, REQUEST_SCHEMA)
    valid, rejected = split_requests(df)
    assert {r["customer_id"]: r["reason"] for r in rejected.collect()} == {
        "c1": "features empty", "c4": "features missing"}
    typed = {r["customer_id"]: r for r in request_columns(valid, ["a", "x", "b"], ["k"]).collect()}
    assert typed["c2"]["a"] == 2.0 and typed["c2"]["x"] == 1.5 and typed["c2"]["b"] is None
    assert typed["c3"]["a"] is None and typed["c3"]["k"] == "K" and typed["c2"]["k"] is None


def test_fused_scale_equals_ml_stages(spark):
    """Row by row: the one-pass formula and the stages that ship, on the same rows."""
    from tests.conftest import SF001
    from riskfold.sources import fixtures

    c = clean.clean(*(lambda d: (d, fixtures.statement_roles(d)))(fixtures.statements(spark, SF001)))
    keep, cols = ["customer_id", "line_no"], [x + "_z" for x in c.roles.numeric]
    a = prep.standard_scale(c.df, c.roles, keep=keep)
    b = prep.prepared_columns(c.df, c.roles, keep, c.df)
    key = [*keep, *[F.round(x, 9).alias(x) for x in cols]]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0 and a.count() == b.count()
    assert b.columns == [*keep, *cols, "c_flag_idx_z", "c_status_idx_z"]


def test_rounded_scores_keep_every_row(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 1), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(pairs, "target int, prob double")
    exact = evaluate.auc_exact(df).first()
    coarse = evaluate.auc_exact(df, decimals=2).first()
    assert (coarse["n_pos"], coarse["n_neg"]) == (exact["n_pos"], exact["n_neg"])
    assert coarse["auc"] == pytest.approx(exact["auc"], abs=0.02)
    assert evaluate.roc_curve(df, decimals=2).count() <= 101


def test_histogram_edges_and_empty_bins(spark):
    df = spark.createDataFrame(
        [(0, 0.2), (0, 0.4), (0, 0.4), (1, 0.5), (None, 0.1), (1, None), (0, float("nan")), (2, 0.3)], "target int, prob double")
    rows = evaluate.score_histogram(df, bins=4).collect()
    assert {(r["target"], r["bin"]): r["n"] for r in rows} == {
        (0, 0): 1, (0, 1): 2, (0, 2): 0, (0, 3): 0, (1, 0): 0, (1, 1): 0, (1, 2): 1, (1, 3): 0}
    own = {(r["target"], r["bin"]): r for r in evaluate.score_histogram(df, bins=2, own_edges=True).collect()}
    assert [own[0, i]["n"] for i in (0, 1)] == [1, 2] and own[0, 0]["bin_lo"] == 0.2 and own[0, 1]["bin_hi"] == pytest.approx(0.4)
    assert [own[1, i]["n"] for i in (0, 1)] == [0, 1] and own[1, 0]["bin_lo"] == 0.0
    assert sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for k, r in own.items() if k[0] == 0) == pytest.approx(1)
