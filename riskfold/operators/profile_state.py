"""Mergeable profile states: profile a table once a month, not once a question.

A state is what one group of rows (a month) adds to the profile: rows, rows
without any feature, and for each column the present values' count, mean and
sum of squared deviations.  States of disjoint rows merge into the state of
all of them, in any order and grouping: counts add up, and means and sums of
squares combine as

    N = sum n_i,  mean = sum n_i mean_i / N,
    m2 = sum m2_i + sum n_i (mean_i - mean)^2

which subtracts no large sums from each other.  A new month reads only its
own rows; profile, rates, means and deviations of everything then come from a
table of (months x columns) rows.

States are stored in versions (:func:`riskfold.session.publish`).  The newest
version that holds a key counts for that key, so a month is corrected by
adding it again, and writers at the same time lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.missing import any_feature_present_sql, lit_str, present_sql, q
from riskfold.operators.profile import role_lookup_sql
from riskfold.roles import Roles
from riskfold.session import publish, versions

KEY = "state_key"
VERSION = "version"

STATE = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_empty", T.LongType()),
    T.StructField("n_present", T.LongType()), T.StructField("mean", T.DoubleType()),
    T.StructField("m2", T.DoubleType()),
])


def profile_states(df: DataFrame, roles: Roles, key: Column | str) -> DataFrame:
    """``state_key`` and :data:`STATE`, one row a key and column, from one aggregate over ``df``.

    ``n_empty`` counts the rows whose features are all missing.  NaN is
    missing in numeric features only.  ``mean`` and ``m2`` are NULL for other
    columns, and where no value is present.  A null key is a key.
    """
    numeric = set(roles.numeric)
    present = any_feature_present_sql(roles)
    aggs = ["count(1) AS n_rows", f"count_if(NOT ({present})) AS n_empty" if present else "count(1) AS n_empty"]
    entries = []
    for i, c in enumerate(df.columns):
        value = present_sql(c, c in numeric and c in roles.floating)
        aggs.append(f"count({value}) AS n{i}")
        mean = m2 = "CAST(NULL AS DOUBLE)"
        if c in numeric:
            aggs += [f"avg(CAST({value} AS DOUBLE)) AS m{i}", f"var_pop(CAST({value} AS DOUBLE)) AS v{i}"]
            mean, m2 = f"m{i}", f"v{i} * n{i}"
        entries.append(f"named_struct('column_name', {lit_str(c)}, 'n_present', n{i}, 'mean', {mean}, 'm2', {m2})")
    key = F.col(key) if isinstance(key, str) else key
    wide = df.withColumn("__key", key).groupBy(F.col("__key").alias(KEY)).agg(*[F.expr(a) for a in aggs])
    long = wide.selectExpr(KEY, "n_rows", "n_empty", f"inline(array({', '.join(entries)}))")
    return long.selectExpr(
        KEY, "column_name", f"{role_lookup_sql(df.columns, roles)} AS role", "n_rows", "n_empty", "n_present", "mean", "m2")


def merge_states(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The states of all rows, or of each group of ``by`` columns, as states again.

    ``states`` are of disjoint rows.  Two passes over the small table: counts
    and means, then the squared deviations around the merged mean.
    """
    by = list(by or [])
    groups = [*by, "column_name"]
    seen = F.col("n_present") > 0
    totals = states.groupBy(*groups).agg(
        F.first("role", ignorenulls=True).alias("role"), F.sum("n_rows").alias("n_rows"), F.sum("n_empty").alias("n_empty"),
        F.sum("n_present").alias("__n"),
        F.try_divide(F.sum(F.when(seen, F.col("n_present") * F.col("mean"))), F.sum(F.when(seen & F.col("mean").isNotNull(), F.col("n_present")))).alias("__mean"))
    means = totals.select(*[F.col(g).alias(f"__g_{i}") for i, g in enumerate(groups)], "__mean")
    same = [F.col(g).eqNullSafe(F.col(f"__g_{i}")) for i, g in enumerate(groups)]
    around = F.col("m2") + F.col("n_present") * F.pow(F.col("mean") - F.col("__mean"), F.lit(2))
    squares = states.join(means, same).groupBy(*groups).agg(F.sum(F.when(seen, around)).alias("__m2"))
    right = squares.select(*[F.col(g).alias(f"__s_{i}") for i, g in enumerate(groups)], "__m2")
    same = [F.col(g).eqNullSafe(F.col(f"__s_{i}")) for i, g in enumerate(groups)]
    return totals.join(right, same, "left").select(
        *groups, "role", "n_rows", "n_empty", F.col("__n").alias("n_present"), F.col("__mean").alias("mean"), F.col("__m2").alias("m2"))


def profile_of(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profile, missing rate, mean and deviation of merged ``states``, one row a column (and group).

    ``n_missing`` and ``pct_missing`` are over all rows; ``missing_rate``, of
    features only, over the rows with any feature, as the cleaning step takes
    it; ``stddev`` is the sample deviation of the present values.
    """
    n, empty, present = F.col("n_rows"), F.col("n_empty"), F.col("n_present")
    feature = F.col("role").isin("numeric", "categorical")
    return states.select(
        *(by or []), "column_name", "role", "n_rows", (n - present).alias("n_missing"),
        (F.try_divide(n - present, n) * 100).alias("pct_missing"), (n - empty).alias("n_kept"),
        F.when(feature, F.try_divide(n - empty - present, n - empty)).alias("missing_rate"),
        "n_present", "mean", F.sqrt(F.try_divide(F.col("m2"), F.when(present > 1, present - 1))).alias("stddev"))


def add_states(states: DataFrame, base: str) -> str:
    """Store states (:func:`profile_states`) as a version of their own under ``base``; its path."""
    return publish(states.sparkSession, lambda path: states.coalesce(1).write.parquet(path), base)  # months x columns rows


def read_states(spark: SparkSession, base: str) -> DataFrame:
    """The stored states, each key's from the newest complete version that holds it."""
    found = versions(spark, base)
    if not found:
        raise FileNotFoundError(f"no profile states under {base}")
    rows = spark.read.parquet(*found).withColumn(VERSION, F.regexp_extract(F.col("_metadata.file_path"), r"/(v[^/]+)/[^/]+$", 1))
    newest = rows.groupBy(F.col(KEY).alias("__key")).agg(F.max(VERSION).alias("__newest"))
    return rows.join(F.broadcast(newest), F.col(KEY).eqNullSafe(F.col("__key")) & (F.col(VERSION) == F.col("__newest"))).select(
        KEY, *STATE.names)
