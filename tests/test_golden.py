"""Golden values of the fixture views (FIXTURES.md §4), Spark side only."""

import pytest

from riskfold.operators import balance, clean, evaluate, prep, profile, split
from riskfold.functions.scoring import risk_level
from riskfold.sources import fixtures
from tests.conftest import SF001, SF01

GOLD = {
    SF001: dict(rows=6000, null_label=617, test_true=731, all_missing=87,
                missing={"n_qty": 900, "n_price": 1623, "n_disc": 0, "n_sparse": 5802, "n_line": 0,
                         "c_flag": 1136, "c_status": 0, "c_rare": 5745},
                rates={"n_sparse": 0.981228, "c_rare": 0.971588},
                means={"n_qty": 25.398564, "n_disc": 0.05047, "n_line": 4.041096, "n_price": 52866.811902},
                classes={0: 3745, 1: 1638}, pct={0: 69.570871, 1: 30.429129},
                inverse={0: 1.437383, 1: 3.286325}, balanced={0: 0.718692, 1: 1.643162},
                cm=(1528, 2611, 1574, 287), auc=0.855321, roc=(230, 160.6915, 96.0559),
                bands={"low": 1077, "medium": 3734, "high": 1189}, hist0=[15, 9, 8, 36]),
    SF01: dict(rows=60000, null_label=4814, test_true=7263, all_missing=535,
               missing={"n_qty": 8604, "n_price": 16174, "n_disc": 72, "n_sparse": 58242, "n_line": 72,
                        "c_flag": 7194, "c_status": 72, "c_rare": 57939},
               rates={"n_sparse": 0.979433, "c_rare": 0.974338},
               means={"n_qty": 25.383771, "n_disc": 0.049914, "n_line": 4.004933, "n_price": 53102.515422},
               classes={0: 38886, 1: 16300}, pct={0: 70.463523, 1: 29.536477},
               inverse={0: 1.419174, 1: 3.385644}, balanced={0: 0.709587, 1: 1.692822},
               cm=(14880, 26599, 15655, 2866), auc=0.852102, roc=(230, 160.159, 96.2103),
               bands={"low": 10746, "medium": 37563, "high": 11691}, hist0=[46, 50, 121, 274]),
}


@pytest.fixture(scope="module", params=[SF001, SF01])
def sf(request):
    return request.param


def _st(spark, sf):
    df = fixtures.statements(spark, sf)
    return df, fixtures.statement_roles(df)


def test_counts_and_profile(spark, sf):
    g = GOLD[sf]
    df, roles = _st(spark, sf)
    prof = {r["column_name"]: r for r in profile.null_nan_profile(df, roles).collect()}
    assert prof["customer_id"]["n_rows"] == g["rows"]
    assert prof["target"]["n_missing"] == g["null_label"]
    assert df.where("test").count() == g["test_true"]
    kept = clean.drop_all_missing_rows(df, roles)
    assert g["rows"] - kept.count() == g["all_missing"]
    rates = {r["column_name"]: r for r in clean.missing_rates(kept, roles).collect()}
    for c, n in g["missing"].items():
        assert rates[c]["n_missing"] == n, c
    for c, v in g["rates"].items():
        assert rates[c]["missing_rate"] == pytest.approx(v, abs=1e-6)
    # invariant: missing + present = rows, for every column
    for r in prof.values():
        assert 0 <= r["n_missing"] <= r["n_rows"]


def test_clean_and_means(spark, sf):
    g = GOLD[sf]
    df, roles = _st(spark, sf)
    c = clean.clean(df, roles)
    assert sorted(c.dropped) == ["c_rare", "n_sparse"]
    assert c.roles.numeric == ("n_qty", "n_price", "n_disc", "n_line")
    assert c.roles.categorical == ("c_flag", "c_status")
    means = {r["column_name"]: r["mean"] for r in prep.column_means(c.df, c.roles).collect()}
    for k, v in g["means"].items():
        assert means[k] == pytest.approx(v, abs=1e-6)


def test_naive_mean_is_nan(spark, sf):
    """The reference's plain avg over a NaN column is NaN (why NaN counts as missing)."""
    from pyspark.sql import functions as F
    import math

    c = clean.clean(*_st(spark, sf))
    assert math.isnan(c.df.agg(F.avg("n_price")).first()[0])


def test_classes_and_weights(spark, sf):
    g = GOLD[sf]
    df, _ = _st(spark, sf)
    dist = {r["target"]: r for r in balance.class_distribution(df, "target").collect()}
    assert {k: v["n"] for k, v in dist.items()} == g["classes"]
    for k, v in g["pct"].items():
        assert dist[k]["percentage"] == pytest.approx(v, abs=1e-6)
    for method in ("inverse", "balanced"):
        w = balance.class_weights(df, "target", method)
        for k, v in g[method].items():
            assert w[k] == pytest.approx(v, abs=1e-6)
    # invariant: balanced weights summed over rows give the row count
    wb = balance.class_weights(df, "target", "balanced")
    assert sum(wb[k] * n for k, n in g["classes"].items()) == pytest.approx(sum(g["classes"].values()))


def test_evaluation(spark, sf):
    from pyspark.sql import functions as F

    g = GOLD[sf]
    s = fixtures.scored(spark, sf)
    cm = evaluate.confusion_counts(s).first()
    assert (cm["tp"], cm["tn"], cm["fp"], cm["fn"]) == g["cm"]
    assert cm["tp"] + cm["tn"] + cm["fp"] + cm["fn"] == cm["n_rows"] == g["rows"]
    assert evaluate.auc_exact(s).first()["auc"] == pytest.approx(g["auc"], abs=1e-6)
    roc = evaluate.roc_curve(s).orderBy(F.desc("score")).collect()
    n, stpr, sfpr = g["roc"]
    assert len(roc) == n
    assert sum(r["tpr"] for r in roc) == pytest.approx(stpr, abs=1e-3)
    assert sum(r["fpr"] for r in roc) == pytest.approx(sfpr, abs=1e-3)
    # monotone, ends at (1, 1)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(roc, roc[1:]))
    assert roc[-1]["tpr"] == 1.0 and roc[-1]["fpr"] == 1.0
    bands = {r["b"]: r["count"] for r in s.groupBy(risk_level("prob").alias("b")).count().collect()}
    assert bands == g["bands"]
    hist = evaluate.score_histogram(s).collect()
    assert sum(r["n"] for r in hist) == g["rows"]
    h0 = {r["bin"]: r["n"] for r in hist if r["target"] == 0}
    assert [h0.get(i, 0) for i in range(4)] == g["hist0"]
    rep = evaluate.metric_report(s).first()
    assert (rep["tp"], rep["tn"], rep["fp"], rep["fn"]) == g["cm"]
    assert rep["auc_scaled"] == pytest.approx(rep["auc"] * 0.855)


def test_evaluator_agrees_with_exact_auc(spark):
    s = fixtures.scored(spark, SF01)
    assert evaluate.evaluator_auc(s, num_bins=0) == pytest.approx(GOLD[SF01]["auc"], abs=1e-6)


def test_hash_split_and_index_order(spark):
    from pyspark.sql import functions as F

    df, roles = _st(spark, SF01)
    lab = df.where(F.col("target").isNotNull())
    sizes = {r["split"]: r["n_rows"] for r in split.split_sizes(split.with_hash_split(lab, "customer_id")).collect()}
    assert sizes == {"train": 44566, "test": 10620}
    c = clean.clean(df, roles)
    idx = prep.string_index(c.df, c.roles)
    order = idx.groupBy("c_flag", "c_flag_idx").count().orderBy("c_flag_idx").collect()
    assert [(r["c_flag"], r["count"]) for r in order] == [("R", 17485), ("A", 17416), ("N", 17370), ("missing", 7194)]
    assert [r["c_flag_idx"] for r in order] == [0.0, 1.0, 2.0, 3.0]
