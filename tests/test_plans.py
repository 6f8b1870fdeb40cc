"""Plan-shape tests: the scale properties the design relies on."""

import re

from riskfold import queries as Q
from riskfold.session import file_stamps, publish, shared_root, versions, written_table
from tests.conftest import SF001


def plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def nodes(text: str) -> list[str]:
    """Operator names, one per physical node (from the details section)."""
    return re.findall(r"^\(\d+\) (\w+)", text, re.M)


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_evaluation_scan_is_pruned(spark):
    p = plan(spark, Q.q_classification_metrics(spark, SF001))
    assert read_schemas(p) == ["l_partkey:bigint,l_quantity:double,l_discount:double"]
    assert nodes(p).count("HashAggregate") == 2  # partial + final


def test_profile_is_one_partial_final_aggregate(spark):
    p = plan(spark, Q.q_null_nan_percent(spark, SF001))
    n = nodes(p)
    assert n.count("Exchange") == 1 and n.count("HashAggregate") == 2
    assert not any("Join" in x or x == "Window" for x in n)


def test_hash_split_and_row_weights_do_not_shuffle(spark):
    for name in ("hash_split", "class_weight_rows", "label_prepare", "request_to_columns"):
        p = plan(spark, Q.QUERIES[name](spark, SF001))
        assert not any("Exchange" in x or "Join" in x for x in nodes(p)), name


def test_roc_window_is_partitioned_by_range(spark):
    p = plan(spark, Q.q_roc_curve(spark, SF001))
    windows = re.findall(r"\(\d+\) Window\n.*?Arguments: (.*?)\n", p, re.S)
    # the offsets window over the per-range totals has no partition key; the
    # running sum over scores is partitioned by range
    assert any("_range" in w.split("[")[-1] or "_range" in w for w in windows)
    assert "BroadcastExchange" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


#: one-row sides, joined to results of one row
ONE_ROW = {"random_split", "bernoulli_sample", "score_stream", "auc_sketch"}
#: a fit each: their plans are checked once, in test_model_query_plans
MODELS = {"train_gbt_a", "train_gbt_b", "score_holdout", "score_bulk", "score_stream", "score_reload", "run_record", "model_info", "fit_layouts"}


def own_queries():
    return {k: v for k, v in Q.QUERIES.items() if k not in MODELS}


def test_no_query_uses_cross_products(spark):
    for name in sorted(set(own_queries()) - ONE_ROW):
        p = plan(spark, Q.QUERIES[name](spark, SF001))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_model_query_plans(spark):
    for name in ("score_holdout", "score_bulk"):
        p = plan(spark, Q.QUERIES[name](spark, SF001))
        n = nodes(p)
        assert not any("Join" in x or "Exchange" in x or "Python" in x or "ArrowEval" in x for x in n), name


def jobs_of(spark, work) -> int:
    """Number of jobs that ``work`` starts."""
    spark.sparkContext.setJobGroup("scan-count", "scan-count")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("scan-count"))
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("scan-count")) - before


def scans(text: str) -> int:
    return nodes(text).count("Scan")


def test_scans(spark):
    """Cleaning is one aggregate; the results add one scan of their own."""
    for name in ("impute_mean", "standard_scale", "clean_table"):
        made = []
        n = jobs_of(spark, lambda name=name: made.append(Q.QUERIES[name](spark, SF001)))
        assert n <= 3 and scans(plan(spark, made[0])) == 1, name  # the footer, and the one aggregate's two stages
    assert scans(plan(spark, Q.QUERIES["split_sizes"](spark, SF001))) == 1
    from riskfold.operators import split

    assert scans(plan(spark, split.with_random_split(spark.read.parquet(f"{SF001}/lineitem.parquet")))) == 1


def test_shared_root_reads_session_setting(spark):
    root = shared_root(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    assert conf is None or root == conf.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_versions_never_replace_each_other(spark, tmp_path):
    base = str(tmp_path / "t")
    assert versions(spark, base) == []
    first = publish(spark, lambda p: spark.range(5).write.parquet(p), base)
    second = publish(spark, lambda p: spark.range(7).write.parquet(p), base)
    assert versions(spark, base) == [first, second]
    assert spark.read.parquet(first).count() == 5 and spark.read.parquet(second).count() == 7

    def broken(path):
        spark.range(3).write.parquet(path)
        raise OSError("lost")

    try:
        publish(spark, broken, base)
    except OSError:
        pass
    assert versions(spark, base) == [first, second]  # an unfinished version does not count


def test_written_table_is_built_once(spark):
    import uuid

    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    name = f"probe-{uuid.uuid4().hex}"
    assert written_table(spark, name, build).count() == 3
    assert written_table(spark, name, build).count() == 3
    assert len(calls) == 1


def test_fingerprint_follows_inner_files_and_parameters(spark, tmp_path):
    from riskfold.sources.fixtures import fingerprint

    base = tmp_path / "sf"
    spark.range(5).write.parquet(str(base / "lineitem.parquet"))
    one = fingerprint(spark, str(base), "a")
    assert one == fingerprint(spark, str(base), "a") == fingerprint(spark, f"file://{base}", "a")
    assert one != fingerprint(spark, str(base), "b")
    inner = next(p for p in (base / "lineitem.parquet").iterdir() if p.name.startswith("part-"))
    inner.write_bytes(inner.read_bytes() + b"x")
    assert one != fingerprint(spark, str(base), "a")
    assert len(file_stamps(spark, str(base / "lineitem.parquet"))) >= 2
    assert file_stamps(spark, str(tmp_path / "absent")) == []


def test_training_leaves_the_session_as_it_is(spark):
    from riskfold.plans import train as train_plan
    from riskfold.sources import fixtures

    conf = lambda: {(r["key"], r["value"]) for r in spark.sql("SET").collect()}
    before = conf()
    st = fixtures.statements(spark, SF001)
    trained = train_plan.fit(st, fixtures.statement_roles(st), preset="quick", id_col="customer_id", maxIter=1)
    train_plan.scored_rows(trained.model, trained.test, ["target"]).count()
    assert conf() == before


def test_categories_and_labels_are_checked_on_request(spark):
    import pytest

    from riskfold.operators import balance
    from riskfold.plans import train as train_plan

    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 1.0)], "k string, y double")
    train_plan.check_categories(df, ["k"], 3)
    with pytest.raises(ValueError, match="more than 2"):
        train_plan.check_categories(df, ["k"], 2)
    with pytest.raises(ValueError, match="0 or 1"):
        balance.class_weights(df.withColumn("y", df["y"] * 2), "y")


def test_explicit_partitions(spark):
    from riskfold.plans import score as score_plan, train as train_plan
    from riskfold.sources import fixtures

    st = fixtures.statements(spark, SF001)
    trained = train_plan.fit(st, fixtures.statement_roles(st), preset="quick", id_col="customer_id", maxIter=1, num_partitions=4)
    p = plan(spark, score_plan.score(st, trained.model, num_partitions=4))
    assert nodes(p).count("Exchange") == 1 and "RoundRobinPartitioning(4)" in p
