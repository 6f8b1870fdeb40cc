"""Scoring requests: ``customer_id`` plus a ``features`` map of strings.

A request is the bulk form of one HTTP prediction body.  Known feature keys
become typed columns (numeric through ``try_cast`` to double, so text in a
numeric field becomes NULL instead of failing the job), absent keys become
NULL, unknown keys are ignored.  An empty map is rejected.  Text that is no
request (a truncated line, ``features`` that is no map) is rejected as
malformed, with the line as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.missing import lit_str, q
from riskfold.sources.tables import read_table

REQUEST_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("features", T.MapType(T.StringType(), T.StringType(), True), True),
])


def request_columns(
    requests: DataFrame, numeric, categorical, id_col: str = "customer_id"
) -> DataFrame:
    """Typed feature columns from the ``features`` map; narrow, no shuffle."""
    def get(c):
        return f"try_element_at(features, {lit_str(c)})"

    return requests.selectExpr(
        q(id_col),
        *[f"try_cast({get(c)} AS DOUBLE) AS {q(c)}" for c in numeric],
        *[f"{get(c)} AS {q(c)}" for c in categorical],
    )


CORRUPT = "_corrupt_record"


def parse_requests(lines: DataFrame) -> DataFrame:
    """Text lines (column ``value``) to ``customer_id, features, raw``; blank lines are no requests.

    ``raw`` holds the line of a malformed request and is NULL otherwise.  The
    options keep Catalyst from narrowing the schema that decides what is
    malformed.
    """
    schema = T.StructType([*REQUEST_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.trim("value") != "").select(F.col("value"), parsed.alias("r")).select(
        "r.customer_id", "r.features",
        F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), F.col("value")).alias("raw"),
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request files with one JSON object a line; see :func:`parse_requests`."""
    return parse_requests(spark.read.text(path))


def reject_reason(raw: bool = False) -> Column:
    """Why a request is rejected, or NULL when it is valid; ``raw``: whether there is such a column."""
    malformed = F.col("raw").isNotNull() if raw else F.lit(False)
    return (
        F.when(malformed, "malformed")
        .when(F.col("features").isNull(), "features missing")
        .when(F.size("features") == 0, "features empty")
    )


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected-with-reason); both are filters of the same scan."""
    reason = reject_reason("raw" in requests.columns)
    valid = requests.where(reason.isNull())
    rejected = requests.where(reason.isNotNull()).withColumn("reason", reason)
    return valid, rejected


def key_counts(requests: DataFrame, numeric, categorical) -> DataFrame:
    """``key, kind, n_requests, n_null, n_failed_cast`` of every key that valid requests have.

    ``kind``: numeric, categorical or unknown (dropped when requests become
    columns).  ``n_failed_cast``: values of a numeric key that are text and no
    number, which become NULL.  One aggregate over the exploded maps, with
    partial sums before the shuffle, so a key in every request is no hot key.
    """
    valid, _ = split_requests(requests)
    return _counted(_entries(valid, numeric, categorical))


def _entries(valid: DataFrame, numeric, categorical) -> DataFrame:
    kinds = {**{c: "categorical" for c in categorical}, **{c: "numeric" for c in numeric}}
    pairs = ", ".join(f"{lit_str(c)}, {lit_str(k)}" for c, k in kinds.items())
    known = f"try_element_at(map({pairs}), key)" if kinds else "CAST(NULL AS STRING)"
    return valid.select(F.explode("features").alias("key", "value")).selectExpr(
        "key", f"coalesce({known}, 'unknown') AS kind", "value")


def _counted(entries: DataFrame) -> DataFrame:
    failed = (F.col("kind") == "numeric") & F.col("value").isNotNull() & F.col("value").try_cast("double").isNull()
    return entries.groupBy("key", "kind").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_if(failed).alias("n_failed_cast"))


def frequent_unknown_keys(valid: DataFrame, numeric, categorical, most: int) -> DataFrame:
    """``key`` of the ``most`` unknown keys with the most requests, ties in key order.

    Counted by a shuffle with partial sums; then each task keeps its ``most``
    largest, so however many keys there are, no step holds more of them.
    """
    unknown = _entries(valid, numeric, categorical).where("kind = 'unknown'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return unknown.orderBy(F.col("n").desc(), "key").limit(most).select("key")


def request_key_report(requests: DataFrame, numeric, categorical, most_unknown: int | None = None) -> DataFrame:
    """:func:`key_counts`, with only the ``most_unknown`` most frequent unknown keys by name where that is given.

    All other unknown keys are one row with key NULL, so the report stays
    small when keys are made up by the thousand; every count is exact.
    """
    if most_unknown is None:
        return key_counts(requests, numeric, categorical)
    valid, _ = split_requests(requests)
    named = frequent_unknown_keys(valid, numeric, categorical, most_unknown).select("key", F.lit(True).alias("__named"))
    entries = _entries(valid, numeric, categorical).join(F.broadcast(named), "key", "left")  # `most_unknown` rows
    key = F.when((F.col("kind") != "unknown") | F.col("__named"), F.col("key"))
    return _counted(entries.select(key.alias("key"), "kind", "value"))


# Requests synthesised from lineitem for bulk and stream scoring: three known
# keys as text, one integer-valued key, one unknown key, text in a numeric
# field for some rows, and an empty map for others.
REQUEST_KEYS = ("n_qty", "n_disc", "n_line", "c_flag", "x_unknown")


def lineitem_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    disc_text = F.when(F.col("l_suppkey") % 17 == 0, F.lit("n/a")).otherwise(
        F.col("l_discount").cast("string")
    )
    full = F.create_map(
        F.lit("n_qty"), F.col("l_quantity").cast("string"),
        F.lit("n_disc"), disc_text,
        F.lit("n_line"), F.col("l_linenumber").cast("string"),
        F.lit("c_flag"), F.col("l_returnflag"),
        F.lit("x_unknown"), F.lit("zzz"),
    )
    empty = F.create_map().cast("map<string,string>")
    return li.select(
        F.col("l_orderkey").cast("string").alias("customer_id"),
        F.when(F.col("l_partkey") % 97 == 5, empty).otherwise(full).alias("features"),
    )


def lineitem_requests_sql() -> str:
    """DuckDB text of :func:`lineitem_requests`."""
    return (
        "requests AS (SELECT CAST(l_orderkey AS VARCHAR) AS customer_id, "
        "CASE WHEN l_partkey % 97 = 5 THEN MAP([]::VARCHAR[], []::VARCHAR[]) "
        "ELSE MAP(['n_qty', 'n_disc', 'n_line', 'c_flag', 'x_unknown'], "
        "[CAST(l_quantity AS VARCHAR), "
        "CASE WHEN l_suppkey % 17 = 0 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END, "
        "CAST(l_linenumber AS VARCHAR), l_returnflag, 'zzz']) END AS features "
        "FROM lineitem)"
    )
