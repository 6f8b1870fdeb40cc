"""Property tests: distributed exact AUC / ROC equal brute force on random inputs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskfold.operators import evaluate

pairs = st.lists(
    st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5, 0.75, 0.9, 1.0])
              | st.floats(0, 1, allow_nan=False)),
    min_size=2, max_size=60,
)


def _brute(ps):
    pos = [s for y, s in ps if y == 1]
    neg = [s for y, s in ps if y == 0]
    if not pos or not neg:
        return None
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ps=pairs, n_ranges=st.integers(1, 6))
def test_auc_equals_brute_force(spark, ps, n_ranges):
    df = spark.createDataFrame(ps, "target int, prob double")
    got = evaluate.auc_exact(df, n_ranges=n_ranges).first()["auc"]
    want = _brute(ps)
    assert (got is None) if want is None else got == pytest.approx(want)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ps=pairs, t=st.sampled_from([0.0, 0.3, 0.5, 0.7, 1.0]))
def test_confusion_partitions_rows(spark, ps, t):
    df = spark.createDataFrame(ps, "target int, prob double")
    cm = evaluate.confusion_counts(df, threshold=t).first()
    assert cm["tp"] + cm["tn"] + cm["fp"] + cm["fn"] == len(ps)
    assert cm["tp"] == sum(1 for y, p in ps if y == 1 and p >= t)


rows3 = st.lists(
    st.tuples(
        st.one_of(st.none(), st.just(float("nan")), st.floats(-5, 5, allow_nan=False)),
        st.one_of(st.none(), st.integers(-3, 3)),
        st.one_of(st.none(), st.sampled_from(["x", "y", ""])),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows3)
def test_missing_semantics_equal_brute_force(spark, rows):
    import math

    from riskfold.operators import clean, profile
    from riskfold.roles import Roles

    df = spark.createDataFrame(rows, "a double, b int, c string")
    roles = Roles.of(df, id_cols=(), label_col=None, categorical=("c",))

    def miss_a(v):
        return v is None or math.isnan(v)

    want_missing = {
        "a": sum(miss_a(r[0]) for r in rows),
        "b": sum(r[1] is None for r in rows),
        "c": sum(r[2] is None for r in rows),
    }
    got = {r["column_name"]: r["n_missing"] for r in profile.null_nan_profile(df, roles).collect()}
    assert got == want_missing
    keep = sum(not (miss_a(r[0]) and r[1] is None and r[2] is None) for r in rows)
    assert clean.drop_all_missing_rows(df, roles).count() == keep


any_pairs = st.lists(
    st.tuples(st.sampled_from([0, 1, None, 2]), st.sampled_from([0.1, 0.5, 0.5, 0.9, None, float("nan")])),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ps=any_pairs, t=st.sampled_from([0.3, 0.5, 0.95]))
def test_both_matrices_follow_one_rule(spark, ps, t):
    import math

    df = spark.createDataFrame(ps, "target int, prob double")
    cm, rep = evaluate.confusion_counts(df, threshold=t).first(), evaluate.metric_report(df, threshold=t).first()
    cells = ("tp", "tn", "fp", "fn", "n_unscored")
    assert [cm[c] for c in cells] == [rep[c] for c in cells]
    assert sum(cm[c] for c in cells) == cm["n_rows"] == sum(y in (0, 1) for y, _ in ps)
    assert cm["n_unscored"] == sum(y in (0, 1) and (p is None or math.isnan(p)) for y, p in ps)
    roc = evaluate.roc_curve(df).collect()
    assert sum(r["pos"] + r["neg"] for r in roc) == cm["n_rows"] - cm["n_unscored"]
