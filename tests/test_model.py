"""Seeded model tests on the statements fixture (sf0.01, quick preset)."""

import pytest
from pyspark.sql import functions as F

from riskfold import queries as Q
from riskfold.operators import evaluate
from riskfold.plans import score as score_plan, train as train_plan
from riskfold.sources import fixtures, requests as req
from tests.conftest import SF01


@pytest.fixture(scope="module")
def trained(spark):
    df = fixtures.statements(spark, SF01)
    return train_plan.fit(df, fixtures.statement_roles(df), preset="quick", id_col="customer_id")


def test_holdout_auc_above_floor(spark, trained):
    scored = train_plan.scored_rows(trained.model, trained.test, ["target"])
    assert evaluate.auc_exact(scored, "target", "prob").first()["auc"] > 0.9
    assert trained.dropped == ["n_sparse", "c_rare"] or sorted(trained.dropped) == ["c_rare", "n_sparse"]


def test_no_customer_on_both_sides(spark, trained):
    a = trained.train.select("customer_id").distinct()
    b = trained.test.select("customer_id").distinct()
    assert a.join(b, "customer_id").count() == 0


def test_reload_gives_identical_scores(spark, trained, tmp_path):
    path = str(tmp_path / "model")
    assert train_plan.save(trained.model, path).startswith(path + "/v")
    again = train_plan.load(path)
    keep = ["customer_id", "line_no", "target"]
    a = train_plan.scored_rows(trained.model, trained.test, keep).withColumnRenamed("prob", "p1")
    b = train_plan.scored_rows(again, trained.test, keep).withColumnRenamed("prob", "p2")
    diff = a.select(F.sum("p1").alias("s")).first()["s"] - b.select(F.sum("p2").alias("s")).first()["s"]
    assert abs(diff) < 1e-9


def test_load_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception):
        train_plan.load(str(tmp_path / "absent"))


def test_bulk_scores_follow_contract(spark, trained):
    scored, rejected = score_plan.score_requests(req.lineitem_requests(spark, SF01), trained.model)
    c = evaluate.output_contract(scored).first()
    assert c["bad_prediction"] == 0 and c["bad_probability"] == 0
    assert c["n_rows"] + rejected.count() == 60000
    bands = scored.where(
        ((F.col("probability") < 0.3) & (F.col("risk_level") != "low"))
        | ((F.col("probability") >= 0.7) & (F.col("risk_level") != "high"))
    )
    assert bands.count() == 0


def test_stream_equals_bulk(spark, trained, tmp_path):
    from riskfold.streaming import read_committed, start_scoring_stream

    src = str(tmp_path / "requests")
    req.lineitem_requests(spark, SF01).write.json(src)
    start_scoring_stream(spark, trained.model, src, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    streamed = read_committed(spark, str(tmp_path / "out"), "scored").drop("batch_id")
    bulk, _ = score_plan.score_requests(req.read_requests(spark, src), trained.model)
    assert streamed.count() == bulk.count()
    assert streamed.exceptAll(bulk).count() == 0
    rejected = read_committed(spark, str(tmp_path / "out"), "rejected")
    assert rejected.count() == 60000 - bulk.count()


def test_stream_restart_is_exactly_once(spark, trained, tmp_path):
    from riskfold.streaming import start_scoring_stream

    src, out, ck = str(tmp_path / "req"), str(tmp_path / "out"), str(tmp_path / "ck")
    reqs = req.lineitem_requests(spark, SF01)
    reqs.limit(0).write.json(src)  # empty source folder with the right layout
    first = reqs.where(F.col("customer_id").cast("long") % 2 == 0)
    first.write.mode("append").json(src)
    start_scoring_stream(spark, trained.model, src, out, ck).awaitTermination()
    n1 = spark.read.parquet(f"{out}/scored").count()
    start_scoring_stream(spark, trained.model, src, out, ck).awaitTermination()  # restart, nothing new
    assert spark.read.parquet(f"{out}/scored").count() == n1
    reqs.where(F.col("customer_id").cast("long") % 2 == 1).write.mode("append").json(src)
    start_scoring_stream(spark, trained.model, src, out, ck).awaitTermination()  # only the new files
    valid = reqs.where(F.size("features") > 0).count()
    assert spark.read.parquet(f"{out}/scored").count() == valid


def test_model_info_latest_per_name(spark, trained, tmp_path):
    from riskfold.sources import runs

    path = str(tmp_path / "runs")
    m = {"auc": 0.9, "precision": 0.5, "recall": 0.5, "f1_score": 0.5, "tp": 1, "tn": 1, "fp": 1, "fn": 1}
    for auc in (0.91, 0.93):
        runs.append_run(runs.run_record(spark, "m1", "p", trained, {**m, "auc": auc}, ["a"]), path)
    runs.append_run(runs.run_record(spark, "m2", "p", trained, m, ["a", "b"]), path)
    info = {r["model_name"]: r for r in runs.model_info(spark, path).collect()}
    assert info["m1"]["n_versions"] == 2 and info["m1"]["auc"] == 0.93
    assert info["m2"]["n_versions"] == 1 and info["m2"]["n_features"] == 2


def test_wide_pipeline_trains_and_scores(spark):
    """~190 columns with the default roles, under Spark's default settings."""
    from tests.conftest import SF001

    assert spark.conf.get("spark.sql.constraintPropagation.enabled", "true") == "true"

    df = fixtures.wide_statements(spark, SF001)
    roles = fixtures.wide_roles(df)
    assert len(roles.numeric) == 179 and len(roles.categorical) == 11
    tr = train_plan.fit(df, roles, preset="quick", id_col="customer_ID")
    assert sorted(tr.dropped) == ["D_68", "n_007", "n_052", "n_097", "n_142"]
    scored = train_plan.scored_rows(tr.model, tr.test, ["target"])
    rep = evaluate.metric_report(scored, "target", "prob").first()
    assert rep["auc"] > 0.9
    assert rep["tp"] + rep["tn"] + rep["fp"] + rep["fn"] == tr.test.count()


def test_imputer_learned_on_training_split_only(spark, trained):
    """D9: surrogates are the training split's means (NaN as missing), not the full table's."""
    from riskfold.operators import prep

    imputer = [s for s in trained.model.stages if s.__class__.__name__ == "ImputerModel"][0]
    surrogate = imputer.surrogateDF.first().asDict()
    means = {r["column_name"]: r["mean"] for r in prep.column_means(trained.train, trained.roles).collect()}
    for c in trained.roles.numeric:
        assert surrogate[prep.numeric_input(trained.roles, c)] == pytest.approx(means[c], rel=1e-12)


def test_serving_imputes_training_means(spark, trained):
    """D2: a missing value scores exactly like the training mean filled in."""
    from riskfold.operators import prep

    imputer = [s for s in trained.model.stages if s.__class__.__name__ == "ImputerModel"][0]
    mean_qty = imputer.surrogateDF.first()[prep.numeric_input(trained.roles, "n_qty")]
    rows = trained.test.select("customer_id", "line_no", "n_qty", "n_price", "n_disc", "n_line",
                               "c_flag", "c_status").limit(200)
    a = rows.withColumn("n_qty", F.lit(None).cast("double"))
    b = rows.withColumn("n_qty", F.lit(mean_qty))
    sa = {(r["customer_id"], r["line_no"]): r["prob"] for r in train_plan.scored_rows(trained.model, a, ["customer_id", "line_no"]).collect()}
    sb = {(r["customer_id"], r["line_no"]): r["prob"] for r in train_plan.scored_rows(trained.model, b, ["customer_id", "line_no"]).collect()}
    assert sa.keys() == sb.keys() and all(sa[k] == pytest.approx(sb[k], abs=1e-12) for k in sa)


def test_training_again_gives_the_new_model(spark, tmp_path):
    """Two fits under one name: the second is loaded, and its recorded AUC is that of the loaded model."""
    from riskfold.sources import runs

    df = fixtures.statements(spark, SF01)
    base, table = str(tmp_path / "model"), str(tmp_path / "runs")
    for seed in (42, 7):
        tr = train_plan.fit(df, fixtures.statement_roles(df), preset="quick", id_col="customer_id", seed=seed, maxIter=3)
        path = train_plan.save(tr.model, base)
        metrics = Q.holdout_metrics(tr.model, tr.test).first().asDict()
        runs.append_run(runs.run_record(spark, "m", path, tr, metrics, ["a"]), table)
    again = train_plan.load(base)
    assert again.stages[-1].getOrDefault("seed") == 7
    assert runs.latest_model_path(spark, table, "m") == train_plan.latest(base) == path
    info = runs.model_info(spark, table).first()
    assert info["n_versions"] == 2 and info["version"] == path.rsplit("/", 1)[1]
    assert info["auc"] == pytest.approx(Q.holdout_metrics(again, tr.test).first()["auc"], abs=1e-12)
    assert list(info["categorical_cols"]) == ["c_flag", "c_status"] and info["tp"] == metrics["tp"]


def test_presets_hold_the_reference_settings():
    """Both presets are trained by the queries train_gbt_a and train_gbt_b in test_oracle."""
    a, b = (train_plan.gbt("y", preset) for preset in ("notebook", "script"))
    assert (a.getMaxIter(), a.getMaxDepth(), a.getSubsamplingRate()) == (60, 6, 0.8)
    assert (b.getMaxIter(), b.getMaxDepth(), b.getSubsamplingRate()) == (100, 5, 1.0)
    assert a.getCheckpointInterval() == 10 and train_plan.gbt("y", checkpoint_every=-1).getCheckpointInterval() == -1


def test_absent_features_count_as_missing(spark, trained):
    rows = trained.test.select("customer_id", "n_qty", "n_price", "n_disc", "c_flag").limit(100)
    full = rows.withColumns({"n_line": F.lit(None).cast("double"), "c_status": F.lit(None).cast("string")})
    a = score_plan.score(rows, trained.model).collect()
    b = score_plan.score(full, trained.model).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    text = rows.withColumn("n_qty", F.col("n_qty").cast("string"))
    assert sorted(map(str, score_plan.score(text, trained.model).collect())) == sorted(map(str, a))


def test_malformed_requests_keep_their_text(spark, trained, tmp_path):
    from riskfold.streaming import start_scoring_stream

    src = tmp_path / "requests"
    src.mkdir()
    lines = [
        '{"customer_id": "1", "features": {"n_qty": "3"}}', '{"customer_id": "2", "features": {"n_qty": ',
        '{"customer_id": "3", "features": "none"}', '{"customer_id": null, "features": {"n_qty": "4"}}', "",
        '{"customer_id": "5", "features": {}}', '{"customer_id": "6"}', "not json",
    ]
    (src / "a.json").write_text("\n".join(lines))
    start_scoring_stream(spark, trained.model, str(src), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = score_plan.score_requests(req.read_requests(spark, str(src)), trained.model)
    stream = [spark.read.parquet(str(tmp_path / "out" / n)) for n in ("scored", "rejected")]
    for scored, rejected in (batch, stream):
        assert sorted(str(r["customer_id"]) for r in scored.collect()) == ["1", "None"]
        got = sorted((r["reason"], r["raw"] or r["customer_id"]) for r in rejected.collect())
        assert got == sorted([
            ("malformed", lines[1]), ("malformed", lines[2]), ("malformed", lines[7]), ("features empty", "5"), ("features missing", "6")])
