"""Registered queries: one per operator, each over the whole given tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame.  Doubles are
rounded to 6 digits and NaN is never emitted, so results hash the same in
Spark and in the DuckDB oracle (``riskfold.oracle``).
"""

from __future__ import annotations

import functools

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.scoring import risk_level, threshold_label
from riskfold.operators import balance, clean as clean_ops, dictionary, draws, evaluate, pool, prep, profile, profile_state, sketch, split
from riskfold.plans import score as score_plan, train as train_plan
from riskfold.roles import schema_report as _schema_report
from riskfold.session import new_version, shared_path, versions
from riskfold.sources import fixtures, requests as req, runs
from riskfold.sources.tables import TABLES, read_table
from riskfold.streaming.score_stream import read_committed, start_scoring_stream

DIGITS = 6
PREVIEW_ROWS = 20
SERVING_PRESET = "script"  # the model the reference's service loads


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (hash hygiene for the oracle compare)."""
    from riskfold.functions.missing import q

    return df.selectExpr(*[
        f"round({q(f.name)}, {digits}) AS {q(f.name)}"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else q(f.name)
        for f in df.schema.fields
    ])


def _statements(spark, sf_dir):
    df = fixtures.statements(spark, sf_dir)
    return df, fixtures.statement_roles(df)


def _cleaned(spark, sf_dir, moments=False):
    df, roles = _statements(spark, sf_dir)
    return clean_ops.clean(df, roles, moments=moments)


# ---------------------------------------------------------------- scans ----

def q_scan_count(spark, sf_dir):
    parts = [
        read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t).alias("table_name"), "n_rows")
        for t in TABLES
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def q_schema_report(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    return _schema_report(spark, df, roles)


def q_preview_topk(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns]).limit(PREVIEW_ROWS)


def q_project_ids(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return df.select("customer_id", "date", "target", "test")


# -------------------------------------------------------------- profile ----

def q_missing_flags(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    return profile.missing_flags(df, roles, keep=["customer_id", "line_no"])


def q_null_nan_profile(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    return profile.null_nan_profile(df, roles)


def q_null_nan_percent(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    return rounded(profile.null_nan_percent(df, roles))


def q_partition_stats(spark, sf_dir):
    """Totals over the partitions, whose own sizes depend on the layout."""
    df, _ = _statements(spark, sf_dir)
    return profile.partition_stats(df).agg(
        F.sum("n_rows").alias("n_rows"), (F.count(F.lit(1)) == F.count_distinct("partition_id")).alias("one_row_each"))


# ---------------------------------------------------------------- clean ----

def q_drop_all_missing_rows(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    return clean_ops.drop_all_missing_rows(df, roles)


def q_missing_rate(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    rows = clean_ops.drop_all_missing_rows(df, roles)
    rates = clean_ops.missing_rates(rows, roles)
    return rounded(rates.withColumn("sparse", F.col("missing_rate") > clean_ops.DEFAULT_MISSING_THRESHOLD))


def q_drop_sparse_columns(spark, sf_dir):
    df, roles = _statements(spark, sf_dir)
    out, _, _ = clean_ops.drop_sparse_columns(df, roles)
    return out


def q_clean_table(spark, sf_dir):
    return _cleaned(spark, sf_dir).df


# -------------------------------------------------------------- prepare ----

def q_column_means(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    return rounded(prep.column_means(c.df, c.roles))


def q_impute_mean(spark, sf_dir):
    c = _cleaned(spark, sf_dir, moments=True)
    means = {k: c.stats["__mean__" + k] for k in c.roles.numeric}
    return rounded(prep.impute_mean(c.df, c.roles, means=means))


def q_fill_categorical(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    return prep.fill_categorical(c.df, c.roles)


def q_string_index(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    return prep.string_index(c.df, c.roles)


def q_standard_scale(spark, sf_dir):
    c = _cleaned(spark, sf_dir, moments=True)
    return rounded(prep.standard_scale(c.df, c.roles, stats=c.stats))


def q_label_prepare(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return train_plan.labelled(df, "target").select("customer_id", "line_no", "target")


# -------------------------------------------------------- split, sample ----

def _labelled_statements(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return train_plan.labelled(df, "target").select("customer_id", "line_no", "target")


def q_hash_split(spark, sf_dir):
    return split.with_hash_split(_labelled_statements(spark, sf_dir), "customer_id")


def _differences(base: DataFrame, other: DataFrame) -> DataFrame:
    """One row: rows of ``base``, rows of it that ``other`` lacks, rows that ``other`` has beyond it."""
    columns = [F.col(c) for c in base.columns]
    both = base.select(*columns, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        other.select(*columns, F.lit(0).alias("a"), F.lit(1).alias("b")))
    each = both.groupBy(*base.columns).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return each.agg(
        F.sum("a").alias("n_rows"), F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("n_missing"),
        F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("n_extra"))


def q_random_split(spark, sf_dir):
    """The two parts together are the table: no row is lost, doubled or in both."""
    base = _labelled_statements(spark, sf_dir)
    both = split.with_random_split(base)
    sizes = split.split_sizes(both)
    share = sizes.agg((F.sum(F.when(F.col("split") == "train", F.col("n_rows"))) / F.sum("n_rows")).alias("share"))
    return _differences(base, both).crossJoin(F.broadcast(share)).select(  # one row
        "n_rows", "n_missing", "n_extra", F.col("share").between(0.77, 0.83).alias("share_near_80"))


def q_split_sizes(spark, sf_dir):
    """Sizes of both splits from one pass; the random parts vary, so they come as their total."""
    lab = split.with_random_split(split.with_hash_split(_labelled_statements(spark, sf_dir), "customer_id", out="hash"), out="random")
    counts = lab.groupBy("hash", "random").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.select(F.explode(F.array(
        F.struct(F.lit("hash").alias("method"), F.col("hash").alias("split"), F.col("n")),
        F.struct(F.lit("random").alias("method"), F.lit("all").alias("split"), F.col("n")),
    )).alias("r"))
    return rows.groupBy("r.method", "r.split").agg(F.sum("r.n").alias("n_rows"))


def q_bernoulli_sample(spark, sf_dir):
    """A sample has only rows of the table, and about the share asked for."""
    base = fixtures.scored(spark, sf_dir)
    sample = split.bernoulli_sample(base)
    share = sample.agg(F.count(F.lit(1)).alias("n"))
    return _differences(base, sample).crossJoin(F.broadcast(share)).select(  # one row
        "n_rows", "n_extra", (F.col("n") / F.col("n_rows")).between(0.03, 0.07).alias("share_near_5"))


# -------------------------------------------------------------- balance ----

def q_class_distribution(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return rounded(balance.class_distribution(df, "target"))


def q_class_weight_inverse(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return rounded(balance.class_weights_frame(df, "target", "inverse"))


def q_class_weight_balanced(spark, sf_dir):
    df, _ = _statements(spark, sf_dir)
    return rounded(balance.class_weights_frame(df, "target", "balanced"))


def q_class_weight_rows(spark, sf_dir):
    """Per-row weight (n-way CASE from the per-class counts; unknown class -> 1.0)."""
    lab = _labelled_statements(spark, sf_dir)
    weights = balance.class_weights(lab, "target", "balanced")
    return rounded(balance.with_class_weight(lab, "target", weights))


# ------------------------------------------------------------- evaluate ----

def q_threshold_label(spark, sf_dir):
    s = fixtures.scored(spark, sf_dir)
    return s.select("target", "prob", threshold_label("prob").alias("prediction"))


def q_risk_band(spark, sf_dir):
    s = fixtures.scored(spark, sf_dir)
    return (
        s.groupBy(risk_level("prob").alias("risk_level"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("prob").alias("min_prob"), F.max("prob").alias("max_prob"))
    )


def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_counts(fixtures.scored(spark, sf_dir))


def q_confusion_percent(spark, sf_dir):
    return rounded(evaluate.confusion_percent(fixtures.scored(spark, sf_dir)))


def q_classification_metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(fixtures.scored(spark, sf_dir)))


def q_roc_curve(spark, sf_dir):
    return rounded(evaluate.roc_curve(fixtures.scored(spark, sf_dir)))


def q_auc_exact(spark, sf_dir):
    return rounded(evaluate.auc_exact(fixtures.scored(spark, sf_dir)))


def q_score_histogram(spark, sf_dir):
    return rounded(evaluate.score_histogram(fixtures.scored(spark, sf_dir)))


def q_score_histogram_edges(spark, sf_dir):
    """Bins between each class's own smallest and largest score."""
    return rounded(evaluate.score_histogram(fixtures.scored(spark, sf_dir), own_edges=True))


def q_metric_report(spark, sf_dir):
    return rounded(evaluate.metric_report(fixtures.scored(spark, sf_dir)))


def q_output_contract(spark, sf_dir):
    s = fixtures.scored(spark, sf_dir)
    return evaluate.output_contract(
        s.select(threshold_label("prob").alias("prediction"), F.col("prob").alias("probability"))
    )


# ------------------------------------------------------------- requests ----

MODEL_NUMERIC = ("n_qty", "n_price", "n_disc", "n_line")
MODEL_CATEGORICAL = ("c_flag", "c_status")


def q_request_to_columns(spark, sf_dir):
    r = req.lineitem_requests(spark, sf_dir)
    return req.request_columns(r, MODEL_NUMERIC, MODEL_CATEGORICAL)


def q_request_valid(spark, sf_dir):
    valid, _ = req.split_requests(req.lineitem_requests(spark, sf_dir))
    return valid.select("customer_id", F.size("features").alias("n_features"))


def q_request_reject(spark, sf_dir):
    _, rejected = req.split_requests(req.lineitem_requests(spark, sf_dir))
    return rejected.select("customer_id", "reason")


# ------------------------------------------------- wide statements (~190) ----

def _wide(spark, sf_dir):
    df = fixtures.wide_statements_view(spark, sf_dir)
    return df, fixtures.wide_roles(df)


def q_wide_null_nan_percent(spark, sf_dir):
    df, roles = _wide(spark, sf_dir)
    return rounded(profile.null_nan_percent(df, roles))


def q_wide_missing_rate(spark, sf_dir):
    df, roles = _wide(spark, sf_dir)
    rates = clean_ops.missing_rates(clean_ops.drop_all_missing_rows(df, roles), roles)
    return rounded(rates.withColumn("sparse", F.col("missing_rate") > clean_ops.DEFAULT_MISSING_THRESHOLD))


def q_wide_clean_table(spark, sf_dir):
    """The cleaned table in an order in which it takes less disk."""
    df, roles = _wide(spark, sf_dir)
    dropped = clean_ops.clean(df, roles).dropped
    return clean_ops.drop_all_missing_rows(fixtures.wide_statements_by_price(spark, sf_dir), roles).drop(*dropped)


def q_wide_column_means(spark, sf_dir):
    df, roles = _wide(spark, sf_dir)
    c = clean_ops.clean(df, roles)
    return rounded(prep.column_means(c.df, c.roles))


def q_wide_string_index(spark, sf_dir):
    """Long ``(column_name, value, idx, n)`` of every categorical's fitted index."""
    df, roles = _wide(spark, sf_dir)
    c = clean_ops.clean(df, roles)
    idx = prep.string_index(c.df, c.roles, keep=[])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col(k).alias("value"), F.col(k + prep.IDX).alias("idx"))
        for k in c.roles.categorical
    ]))
    return (
        idx.select(pairs.alias("p")).select("p.*")
        .groupBy("column_name", "value", "idx").agg(F.count(F.lit(1)).alias("n"))
    )


# --------------------------------------------------------------- models ----

def _code_of_training() -> str:
    """Presets and source of the modules that make a model."""
    import inspect

    return repr(train_plan.PRESETS) + "".join(inspect.getsource(m) for m in (train_plan, draws, pool, prep, clean_ops, balance, split))


def _model_base(spark, sf_dir, preset):
    print_ = fixtures.fingerprint(spark, sf_dir, preset, _code_of_training())
    return shared_path(spark, "riskfold", "models", f"statements-{preset}-{print_}")


def _fitted(spark, sf_dir, preset):
    df, roles = _statements(spark, sf_dir)
    return train_plan.fit(df, roles, preset=preset, id_col="customer_id")


def serving_model(spark, sf_dir, preset=SERVING_PRESET):
    """The newest saved model for these files, preset and code; fitted and saved if there is none."""
    base = _model_base(spark, sf_dir, preset)
    if not versions(spark, base):
        train_plan.save(_fitted(spark, sf_dir, preset).model, base)
    return train_plan.load(base)


def holdout_metrics(model, test) -> DataFrame:
    """One row of hold-out metrics (exact AUC, confusion at ``prob >= 0.5``, rates).

    One scoring pass: the scored hold-out is reduced to distinct scores once
    and every metric is read off that table.
    """
    return evaluate.metric_report(train_plan.scored_rows(model, test, ["target"]), "target", "prob")


def _holdout(spark, sf_dir):
    """Hold-out rows of the labelled statements; dropped columns are the model's affair."""
    df, roles = _statements(spark, sf_dir)
    lab = train_plan.labelled(clean_ops.drop_all_missing_rows(df, roles), "target")
    _, test = split.hash_split(lab, "customer_id")
    return test


def train_report(spark, sf_dir, preset) -> DataFrame:
    """Fit a preset, save it and report its hold-out metrics."""
    trained = _fitted(spark, sf_dir, preset)
    train_plan.save(trained.model, _model_base(spark, sf_dir, preset))
    gbt = trained.model.stages[-1]
    return holdout_metrics(trained.model, trained.test).select(
        F.lit(preset).alias("preset"),
        F.lit(gbt.getNumTrees).alias("n_trees"),
        F.lit(gbt.numFeatures).alias("n_features"),
        "auc", "tp", "tn", "fp", "fn", "n_unscored", "precision", "recall", "f1_score",
    )


def _train_counts(spark, sf_dir, preset):
    """The exact part of :func:`train_report`; the cells sum up to the hold-out."""
    return train_report(spark, sf_dir, preset).select(
        "preset", "n_trees", "n_features", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_holdout"),
        "n_unscored", (F.col("auc") > 0.9).alias("auc_above_floor"),
    )


def q_train_gbt_a(spark, sf_dir):
    return _train_counts(spark, sf_dir, "notebook")


def q_train_gbt_b(spark, sf_dir):
    return _train_counts(spark, sf_dir, "script")


def q_prepare_features(spark, sf_dir):
    """The preparation stages that ship, fitted on the training rows; one column a feature of the vector."""
    c = _cleaned(spark, sf_dir)
    lab = train_plan.labelled(c.df, "target")
    train, _ = split.hash_split(lab, "customer_id")
    train = train.select(*c.roles.features).persist(StorageLevel.MEMORY_AND_DISK)  # three stages are fitted on it
    try:
        out = prep.prepared_columns(c.df, c.roles, ["customer_id", "line_no"], train)
    finally:
        train.unpersist()
    return rounded(out)


def q_score_holdout(spark, sf_dir):
    model = serving_model(spark, sf_dir)
    scored = train_plan.scored_rows(model, _holdout(spark, sf_dir), ["customer_id", "line_no", "target"])
    good = F.col("prob").between(0, 1) & (F.col("prediction") == (F.col("prob") >= 0.5).cast("int"))
    return scored.select("customer_id", "line_no", "target", good.alias("in_contract"))


def q_auc_evaluator(spark, sf_dir):
    """Spark's evaluator over all scores and the exact AUC, on one copy of (label, score)."""
    scored = fixtures.scored(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        exact = evaluate.evaluator_auc(scored, "target", "prob", num_bins=0)
        own = evaluate.auc_exact(scored, "target", "prob")
    finally:
        scored.unpersist()
    return rounded(own.select("auc", F.lit(exact).alias("evaluator_auc"), "n_pos", "n_neg"))


_TRAINED: dict[str, train_plan.Trained] = {}


def _trained(spark, sf_dir) -> train_plan.Trained:
    """The serving preset fitted in this process on these files; the keys on saving and recording share one fit."""
    key = _model_base(spark, sf_dir, SERVING_PRESET)
    if key not in _TRAINED:
        _TRAINED[key] = _fitted(spark, sf_dir, SERVING_PRESET)
    return _TRAINED[key]


def q_score_reload(spark, sf_dir):
    """Scores of a model before it is saved and after it is loaded: rows and differences."""
    trained = _trained(spark, sf_dir)
    again = train_plan.load(train_plan.save(trained.model, _model_base(spark, sf_dir, SERVING_PRESET)))
    keep = ["customer_id", "line_no", "target"]
    return _differences(
        train_plan.scored_rows(trained.model, trained.test, keep), train_plan.scored_rows(again, trained.test, keep))


def _in_contract() -> F.Column:
    p = F.col("probability")
    band = F.when(p < 0.3, "low").when(p < 0.7, "medium").otherwise("high")
    return p.between(0, 1) & (F.col("prediction") == (p >= 0.5).cast("int")) & (F.col("risk_level") == band)


def q_score_bulk(spark, sf_dir):
    scored, _ = score_plan.score_requests(req.lineitem_requests(spark, sf_dir), serving_model(spark, sf_dir))
    return scored.select("customer_id", _in_contract().alias("in_contract"))


def q_score_stream(spark, sf_dir):
    """Scored and rejected rows of a stream over request files, and how they differ from bulk scoring."""
    model = serving_model(spark, sf_dir)
    run = new_version(shared_path(spark, "riskfold", "streams"))
    requests = req.lineitem_requests(spark, sf_dir)
    requests.write.json(f"{run}/requests")
    start_scoring_stream(spark, model, f"{run}/requests", f"{run}/out", f"{run}/checkpoint").awaitTermination()
    bulk, _ = score_plan.score_requests(requests, model)
    streamed = read_committed(spark, f"{run}/out", "scored").select(*bulk.columns)
    rejected = read_committed(spark, f"{run}/out", "rejected").agg(F.count(F.lit(1)).alias("n_rejected"))
    return _differences(rounded(bulk), rounded(streamed)).crossJoin(F.broadcast(rejected))  # one row


def _recorded_run(spark, sf_dir) -> str:
    """A runs table with two runs of the serving preset, the first one compacted, made in this call; its path."""
    runs_path = new_version(shared_path(spark, "riskfold", "runs"))
    trained = _trained(spark, sf_dir)
    path = train_plan.save(trained.model, _model_base(spark, sf_dir, SERVING_PRESET))
    metrics = holdout_metrics(trained.model, trained.test).first().asDict()
    for n in range(2):
        runs.append_run(runs.run_record(
            spark, f"statements-{SERVING_PRESET}", path, trained, metrics, prep.feature_input_cols(trained.roles)), runs_path)
        if n == 0:
            runs.compact_runs(spark, runs_path)
    return runs_path


def _recorded(df: DataFrame) -> DataFrame:
    """The exact part of run rows: names, and the cells' sum, which is the hold-out."""
    joined = lambda c: F.array_join(F.sort_array(c), ",").alias(c)
    return df.select(
        "model_name", "preset", joined("numeric_cols"), joined("categorical_cols"),
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_holdout"), (F.col("auc") > 0.9).alias("auc_above_floor"),
        *[c for c in ("n_versions", "n_features") if c in df.columns],
        *([joined("dropped_cols"), joined("feature_input_cols"), "label_col"] if "dropped_cols" in df.columns else []),
    )


def q_run_record(spark, sf_dir):
    return _recorded(runs.read_runs(spark, _recorded_run(spark, sf_dir)))


def q_model_info(spark, sf_dir):
    return _recorded(runs.model_info(spark, _recorded_run(spark, sf_dir)))


# ------------------------------------------------------ mergeable states ----

def _month() -> F.Column:
    return F.substring("date", 1, 7)


def _profile_states(spark, sf_dir) -> DataFrame:
    """States of all months, stored as two versions: all but the last month, then that one from its own rows."""
    df, roles = _statements(spark, sf_dir)
    base = new_version(shared_path(spark, "riskfold", "profile-states"))
    last = df.agg(F.max(_month())).first()[0]
    for part in (df.where(_month() < last), df.where(_month() == last)):
        profile_state.add_states(profile_state.profile_states(part, roles, _month()), base)
    return profile_state.read_states(spark, base)


def q_profile_state_months(spark, sf_dir):
    """Profile of each month, from the stored states."""
    states = _profile_states(spark, sf_dir)
    return rounded(profile_state.profile_of(states, [profile_state.KEY])).select(
        profile_state.KEY, "column_name", "role", "n_rows", "n_missing", "pct_missing", "n_kept", "missing_rate", "n_present", "mean", "stddev")


def q_profile_state_merged(spark, sf_dir):
    """Profile, missing rates, means and deviations of the whole table from the months' states: years first, then all."""
    states = _profile_states(spark, sf_dir)
    years = profile_state.merge_states(states.withColumn("year", F.substring(profile_state.KEY, 1, 4)), ["year"])
    return rounded(profile_state.profile_of(profile_state.merge_states(years)))


def q_value_dictionary(spark, sf_dir):
    """The dictionary of the categoricals and of two columns of many values, one of them with a hot value."""
    c = _cleaned(spark, sf_dir)
    df = c.df.withColumn("v_price", F.when(F.col("line_no") % 3 == 0, F.lit("hot")).otherwise(F.col("n_price").try_cast("decimal(18,2)").cast("string")))
    return dictionary.value_dictionary(df, [*c.roles.categorical, "customer_id", "v_price"])


def q_string_index_joined(spark, sf_dir):
    """Index of the categoricals and of every customer, by joins; few values are broadcast, so both joins are taken."""
    c = _cleaned(spark, sf_dir)
    columns = [*c.roles.categorical, "customer_id"]
    values = dictionary.value_dictionary(c.df, columns)
    out = dictionary.index_with(c.df.select("customer_id", "line_no", *c.roles.categorical), values, columns)
    return out.select("customer_id", "line_no", *[x for k in c.roles.categorical for x in (
        F.col(f"{k}__value").alias(k), F.col(f"{k}{prep.IDX}"))], f"customer_id{prep.IDX}")


def q_auc_sketch(spark, sf_dir):
    """Area and error bound from the merged sketches of parts of the rows, next to the exact area."""
    df = fixtures.scored(spark, sf_dir).withColumn("part", F.floor(F.col("prob") * 7919) % 5)
    merged = sketch.merge_sketches(sketch.score_sketch(df, bits=8, by=["part"]))
    exact = evaluate.auc_exact(df).select(F.col("auc").alias("exact"))
    both = sketch.auc_of(merged).crossJoin(F.broadcast(exact))  # one row each
    within = F.abs(F.col("auc") - F.col("exact")) <= F.col("error_bound") + 1e-12
    return rounded(both.select("auc", "error_bound", "n_pos", "n_neg", "n_unscored", within.alias("within_bound")))


def q_request_key_report(spark, sf_dir):
    return req.request_key_report(req.lineitem_requests(spark, sf_dir), MODEL_NUMERIC, MODEL_CATEGORICAL)


def q_request_key_top(spark, sf_dir):
    """Requests with a key of their own part's name: only the most frequent unknown keys are named."""
    own = F.map_from_arrays(F.array(F.concat(F.lit("x_"), F.col("customer_id").cast("long") % 97)), F.array(F.lit("1")))
    r = req.lineitem_requests(spark, sf_dir).withColumn(
        "features", F.when(F.size("features") > 0, F.map_concat("features", own)).otherwise(F.col("features")))
    return req.request_key_report(r, MODEL_NUMERIC, MODEL_CATEGORICAL, most_unknown=10)


LAYOUTS = (1, 4, 8)
#: Rows of one partition at most, in the layout of the fewest: more rows make all layouts wider by the same factor.
LAYOUT_ROWS = 4_000_000


def q_fit_layouts(spark, sf_dir):
    """The notebook's row sampling over three layouts of the same rows: the trees are the same.

    Twelve rounds a fit: each draws rows anew, which is what depends on the layout.
    A table of more than ``LAYOUT_ROWS`` rows has so many times the partitions,
    in every layout and in the fit, so no task reads more as the table grows.
    """
    df, roles = _statements(spark, sf_dir)
    times = max(1, -(-df.count() // LAYOUT_ROWS))
    digests = [train_plan.model_digest(train_plan.fit(
        df.repartition(n * times), roles, preset="notebook", id_col="customer_id", num_partitions=8 * times,
        row_key=["customer_id", "line_no"], maxIter=12).model) for n in LAYOUTS]
    rows = [(n, d == digests[0]) for n, d in zip(LAYOUTS, digests)]
    return spark.createDataFrame(rows, "input_partitions int, same_trees boolean")


QUERIES = {
    "scan_count": q_scan_count,
    "schema_report": q_schema_report,
    "preview_topk": q_preview_topk,
    "project_ids": q_project_ids,
    "missing_flags": q_missing_flags,
    "null_nan_profile": q_null_nan_profile,
    "null_nan_percent": q_null_nan_percent,
    "drop_all_missing_rows": q_drop_all_missing_rows,
    "missing_rate": q_missing_rate,
    "drop_sparse_columns": q_drop_sparse_columns,
    "clean_table": q_clean_table,
    "column_means": q_column_means,
    "impute_mean": q_impute_mean,
    "fill_categorical": q_fill_categorical,
    "string_index": q_string_index,
    "standard_scale": q_standard_scale,
    "label_prepare": q_label_prepare,
    "hash_split": q_hash_split,
    "class_distribution": q_class_distribution,
    "class_weight_inverse": q_class_weight_inverse,
    "class_weight_balanced": q_class_weight_balanced,
    "class_weight_rows": q_class_weight_rows,
    "threshold_label": q_threshold_label,
    "risk_band": q_risk_band,
    "confusion_matrix": q_confusion_matrix,
    "confusion_percent": q_confusion_percent,
    "classification_metrics": q_classification_metrics,
    "roc_curve": q_roc_curve,
    "auc_exact": q_auc_exact,
    "score_histogram": q_score_histogram,
    "score_histogram_edges": q_score_histogram_edges,
    "metric_report": q_metric_report,
    "output_contract": q_output_contract,
    "request_to_columns": q_request_to_columns,
    "request_valid": q_request_valid,
    "request_reject": q_request_reject,
    "wide_null_nan_percent": q_wide_null_nan_percent,
    "wide_missing_rate": q_wide_missing_rate,
    "wide_clean_table": q_wide_clean_table,
    "wide_column_means": q_wide_column_means,
    "wide_string_index": q_wide_string_index,
    # of model output, samples and layouts the part that is exact
    "partition_stats": q_partition_stats,
    "random_split": q_random_split,
    "split_sizes": q_split_sizes,
    "bernoulli_sample": q_bernoulli_sample,
    "prepare_features": q_prepare_features,
    "train_gbt_a": q_train_gbt_a,
    "train_gbt_b": q_train_gbt_b,
    "score_holdout": q_score_holdout,
    "auc_evaluator": q_auc_evaluator,
    "score_reload": q_score_reload,
    "score_bulk": q_score_bulk,
    "score_stream": q_score_stream,
    "run_record": q_run_record,
    "model_info": q_model_info,
    "profile_state_months": q_profile_state_months,
    "profile_state_merged": q_profile_state_merged,
    "value_dictionary": q_value_dictionary,
    "string_index_joined": q_string_index_joined,
    "auc_sketch": q_auc_sketch,
    "request_key_report": q_request_key_report,
    "request_key_top": q_request_key_top,
    "fit_layouts": q_fit_layouts,
}
