"""Mergeable profile states, dictionaries as tables, score sketches and key reports against plain computation."""

import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from riskfold.operators import dictionary, evaluate, prep, profile, profile_state, sketch
from riskfold.roles import Roles
from riskfold.session import new_version, shared_path
from riskfold.sources import requests as req

SCHEMA = "id long, month string, x double, k int, c string, y int"


def rows(n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        empty = rng.random() < 0.1
        x = None if empty else rng.choice([None, float("nan"), 1e9 + rng.random(), 1e9])
        k = None if empty else rng.choice([None, 1, 2, 3])
        c = None if empty else rng.choice([None, "a", "b", ""])
        out.append((i, rng.choice(["2020-01", "2020-02", "2021-01", None]), x, k, c, rng.choice([0, 1, None])))
    return out


def roles_of(df):
    return Roles.of(df, id_cols=("id", "month"), label_col="y", categorical=("c",))


def by_hand(data):
    """column -> (n_rows, n_missing, n_kept, n_present, mean, stddev)"""
    real = lambda v: v is not None and not (isinstance(v, float) and math.isnan(v))
    kept = sum(any(real(v) for v in r[2:5]) for r in data)
    out = {}
    for i, name in enumerate(["id", "month", "x", "k", "c", "y"]):
        present = [r[i] for r in data if real(r[i])]
        number = name in ("x", "k") and present
        out[name] = (len(data), len(data) - len(present), kept, len(present), statistics.fmean(present) if number else None,
                     statistics.stdev(present) if number and len(present) > 1 else None)
    return out


def check(got, data):
    want = by_hand(data)
    assert {r["column_name"] for r in got} == set(want)
    for r in got:
        n, missing, kept, present, mean, dev = want[r["column_name"]]
        assert (r["n_rows"], r["n_missing"], r["n_kept"], r["n_present"]) == (n, missing, kept, present)
        assert r["pct_missing"] == pytest.approx(missing / n * 100)
        if r["column_name"] in ("x", "k", "c"):
            assert r["missing_rate"] == pytest.approx((kept - present) / kept)
        assert r["mean"] == (None if mean is None else pytest.approx(mean, rel=1e-14))
        # values around 1e9 that differ by less than 1: a difference of large sums would lose all digits
        assert r["stddev"] == (None if dev is None else pytest.approx(dev, rel=1e-6))


def test_merged_states_equal_one_pass(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    states = profile_state.profile_states(df, roles_of(df), "month").persist()
    assert states.count() == 4 * 6
    check(profile_state.profile_of(profile_state.merge_states(states)).collect(), data)
    halves = profile_state.merge_states(states.withColumn("half", F.col("state_key") < "2020-02"), ["half"])
    check(profile_state.profile_of(profile_state.merge_states(halves)).collect(), data)
    for month in ("2020-01", None):
        mine = [r for r in data if r[1] == month]
        check(profile_state.profile_of(states.where(F.col("state_key").eqNullSafe(month))).collect(), mine)
    plain = {r["column_name"]: r["n_missing"] for r in profile.null_nan_profile(df, roles_of(df)).collect()}
    assert plain == {r["column_name"]: r["n_missing"] for r in profile_state.profile_of(profile_state.merge_states(states)).collect()}
    states.unpersist()


def test_states_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame(rows(1), SCHEMA)
    empty = profile_state.profile_states(df.where("false"), roles_of(df), "month")
    assert empty.count() == 0 and profile_state.merge_states(empty).count() == 0
    one = spark.createDataFrame([(1, "m", 5.0, None, None, 1)], SCHEMA)
    got = {r["column_name"]: r for r in profile_state.profile_of(
        profile_state.merge_states(profile_state.profile_states(one, roles_of(one), "month"))).collect()}
    assert got["x"]["mean"] == 5.0 and got["x"]["stddev"] is None and got["k"]["mean"] is None and got["k"]["missing_rate"] == 1.0


def test_the_newest_version_of_a_month_counts_and_others_stay(spark):
    base = new_version(shared_path(spark, "test-states"))
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    states = lambda d: profile_state.profile_states(d, roles_of(d), "month")
    with pytest.raises(FileNotFoundError):
        profile_state.read_states(spark, base)
    profile_state.add_states(states(df.where("month < '2021-01' or month is null")), base)
    profile_state.add_states(states(df.where("month = '2021-01'").limit(3)), base)
    profile_state.add_states(states(df.where("month = '2021-01'")), base)  # corrects it
    check(profile_state.profile_of(profile_state.merge_states(profile_state.read_states(spark, base))).collect(), data)


def test_an_added_month_reads_only_its_own_files(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).where("month is not null")
    df.write.partitionBy("month").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    added = profile_state.profile_states(table.where("month = '2020-02'"), roles_of(table), "month")
    plan = spark._jvm.PythonSQLUtils.explainString(added._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*month.*2020-02", plan) and plan.count("Scan parquet") <= 2
    assert {r["state_key"] for r in added.collect()} == {"2020-02"}


# ---- dictionaries ----

def test_dictionary_equals_the_indexer(spark):
    rng = random.Random(2)
    data = [(i, "hot" if rng.random() < 0.4 else rng.choice([None, f"v{rng.randrange(300)}", ""]), rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, c string, d int").repartition(6)
    roles = Roles.of(df, id_cols=("id",), label_col=None, categorical=("c", "d"))
    rows_of = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    want = prep.string_index(df, roles)
    for frequent in (1000, 7, 1):
        got = dictionary.string_index(df, roles, frequent=frequent)
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want)


def test_unseen_values_get_the_number_after_the_last(spark):
    seen = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, c string")
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (4, "missing")], "id long, c string")
    roles = Roles.of(df, id_cols=("id",), label_col=None, categorical=("c",))
    for frequent in (1000, 1):
        got = {r["id"]: r["c_idx"] for r in dictionary.string_index(df, roles, fit_on=seen, frequent=frequent).collect()}
        assert got == {1: 0.0, 2: 3.0, 3: 2.0, 4: 2.0}
    empty = dictionary.string_index(df.where("false"), roles)
    assert empty.count() == 0 and empty.columns == ["id", "c", "c_idx"]


def test_dictionary_ranks_do_not_depend_on_the_ranges(spark):
    rng = random.Random(4)
    data = [(f"a{rng.randrange(400)}", f"b{min(rng.randrange(60), rng.randrange(60))}") for _ in range(5000)]
    df = spark.createDataFrame(data, "p string, q string").repartition(9)
    got = dictionary.value_dictionary(df, ["p", "q"]).collect()
    for i, c in enumerate(["p", "q"]):
        counts = {}
        for r in data:
            counts[r[i]] = counts.get(r[i], 0) + 1
        order = sorted(counts, key=lambda v: (-counts[v], v))
        assert {r["value"]: (r["n"], r["idx"]) for r in got if r["column_name"] == c} == {
            v: (counts[v], k) for k, v in enumerate(order)}
    # no task numbers a whole column
    plan = spark._jvm.PythonSQLUtils.explainString(dictionary.value_dictionary(df, ["p"])._jdf.queryExecution(), "formatted")
    assert "SinglePartition" not in plan


# ---- sketches ----

def auc_by_hand(data):
    pos = [s for y, s in data if y == 1 and s is not None and not math.isnan(s)]
    neg = [s for y, s in data if y == 0 and s is not None and not math.isnan(s)]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_area_is_within_the_bound(spark, bits):
    rng = random.Random(bits)
    kinds = {
        "spread": lambda y: min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))),
        "hot": lambda y: 0.5 if rng.random() < 0.6 else rng.random(),
        "near": lambda y: 0.5 + rng.random() * 1e-6 + y * 5e-7,
        "outside": lambda y: rng.choice([-3.0, 0.0, 1.0, 7.5, float("inf")]),
        "holes": lambda y: rng.choice([None, float("nan"), rng.random()]),
    }
    data = [(k, y, f(y)) for k, f in kinds.items() for y in [rng.choice([0, 1, 1]) for _ in range(200)]]
    data += [("one class", 1, 0.3), ("one class", None, 0.2), ("one class", 2, 0.9)]
    df = spark.createDataFrame(data, "kind string, target int, prob double").repartition(4)
    parts = sketch.score_sketch(df.withColumn("part", F.col("target")), bits=bits, by=["kind", "part"])
    got = {r["kind"]: r for r in sketch.auc_of(sketch.merge_sketches(parts, ["kind"]), ["kind"]).collect()}
    for k in kinds:
        mine = [(y, s) for kind, y, s in data if kind == k]
        want = auc_by_hand(mine)
        assert abs(got[k]["auc"] - want) <= got[k]["error_bound"] + 1e-12
        assert got[k]["n_unscored"] == sum(s is None or math.isnan(s) for _, s in mine)
    assert got["one class"]["auc"] is None and got["one class"]["n_pos"] == 1
    if bits == 12:
        assert got["outside"]["error_bound"] < 0.5 and got["spread"]["error_bound"] < 1e-3


def test_a_hot_score_costs_no_exactness_and_size_is_fixed(spark):
    df = spark.range(20_000).select((F.col("id") % 2).cast("int").alias("target"), F.when(F.col("id") % 3 == 0, 0.25).otherwise(
        F.round(F.col("id") % 11 / 11, 4)).alias("prob"))
    s = sketch.score_sketch(df, bits=6)
    assert s.count() <= 65
    r = sketch.auc_of(s).first()
    assert r["error_bound"] == 0.0 and r["auc"] == pytest.approx(evaluate.auc_exact(df).first()["auc"], abs=1e-12)
    none = sketch.auc_of(sketch.score_sketch(df.where("false"))).collect()
    assert len(none) == 1 and none[0]["auc"] is None and none[0]["n_pos"] == 0


def test_the_sketch_is_one_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("target"), (F.col("id") / 100).alias("prob"))
    plan = spark._jvm.PythonSQLUtils.explainString(sketch.score_sketch(df)._jdf.queryExecution(), "simple")
    assert len(re.findall(r"Exchange ", plan.split("Initial Plan")[0])) == 1 and "Sort " not in plan


def test_quantiles_lie_between_their_ends(spark):
    values = [random.Random(9).random() for _ in range(500)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "target int, prob double")
    ordered = sorted(values)
    for r in sketch.quantiles_of(sketch.score_sketch(df, bits=8), [0.0, 0.1, 0.5, 0.99, 1.0]).collect():
        v = ordered[max(1, math.ceil(r["share"] * 500)) - 1]
        assert r["lo"] <= v <= r["hi"] <= r["lo"] + 1 / 256


# ---- request keys ----

def test_request_keys(spark):
    data = [
        ("1", {"n": "1.5", "c": "x", "u": "1"}), ("2", {"n": "n/a", "c": None, "v": "1"}), ("3", {"n": None, "u": None}),
        ("4", {}), ("5", None), ("6", {"n": " 2 ", "": "x", "u": "2", "N": "3"}),
    ] + [(str(i), {f"made{i}": "1", "hot": "x"}) for i in range(10, 60)]
    df = spark.createDataFrame(data, "customer_id string, features map<string,string>").repartition(3)
    got = {(r["key"], r["kind"]): tuple(r)[2:] for r in req.request_key_report(df, ["n"], ["c"]).collect()}
    assert got[("n", "numeric")] == (4, 1, 1) and got[("c", "categorical")] == (2, 1, 0)
    assert got[("u", "unknown")] == (3, 1, 0) and got[("hot", "unknown")] == (50, 0, 0) and got[("", "unknown")] == (1, 0, 0)
    assert len(got) == 7 + 50
    few = {(r["key"], r["kind"]): tuple(r)[2:] for r in req.request_key_report(df, ["n"], ["c"], most_unknown=2).collect()}
    assert few == {k: got[k] for k in (("n", "numeric"), ("c", "categorical"), ("hot", "unknown"), ("u", "unknown"))} | {
        (None, "unknown"): (53, 0, 0)}
    assert req.request_key_report(df.where("false"), ["n"], []).count() == 0
    none = req.request_key_report(df, [], [])
    assert {r["kind"] for r in none.collect()} == {"unknown"}
