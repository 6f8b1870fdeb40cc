"""Fixture views derived from ``lineitem``.

The supplied tables hold no NULL and no NaN, so missingness is injected by
deterministic rules on the keys.  Each view is a list of ``(alias, expr)``
pairs whose text is valid in both Spark SQL and DuckDB; Spark evaluates it
with ``selectExpr`` over the Parquet scan (so pruning and pushdown still
apply) and the oracle wraps the same text in a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfold.roles import Roles
from riskfold.sources.tables import read_table

# Timestamp literal: ``l_shipdate`` is a timestamp without time zone, so Spark
# compares it with an NTZ literal and DuckDB with its plain TIMESTAMP.
_TS = {"spark": "TIMESTAMP_NTZ '2001-01-01 00:00:00'", "duckdb": "TIMESTAMP '2001-01-01 00:00:00'"}

STATEMENTS = (
    ("customer_id", "l_orderkey"),
    ("line_no", "l_linenumber"),
    ("date", "CAST(CAST(l_shipdate AS DATE) AS STRING)"),
    ("test", "l_shipdate >= {ts}"),
    ("target", "CASE WHEN l_suppkey % 13 = 3 THEN NULL "
               "WHEN l_quantity > 30 AND l_discount >= 0.05 THEN 1 "
               "WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END"),
    ("n_qty", "CASE WHEN l_partkey % 97 = 5 OR l_partkey % 7 = 0 THEN NULL ELSE l_quantity END"),
    ("n_price", "CASE WHEN l_partkey % 97 = 5 THEN CAST('NaN' AS DOUBLE) "
                "WHEN l_partkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) "
                "WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice END"),
    ("n_disc", "CASE WHEN l_partkey % 97 = 5 THEN NULL ELSE l_discount END"),
    ("n_sparse", "CASE WHEN l_partkey % 50 = 1 THEN l_tax ELSE NULL END"),
    ("n_line", "CASE WHEN l_partkey % 97 = 5 THEN NULL ELSE l_linenumber END"),
    ("c_flag", "CASE WHEN l_partkey % 97 = 5 OR l_suppkey % 9 = 0 THEN NULL ELSE l_returnflag END"),
    ("c_status", "CASE WHEN l_partkey % 97 = 5 THEN NULL ELSE l_linestatus END"),
    ("c_rare", "CASE WHEN l_partkey % 40 = 3 THEN l_returnflag ELSE NULL END"),
)

STATEMENT_ID_COLS = ("customer_id", "line_no", "date", "test")
STATEMENT_LABEL = "target"
STATEMENT_CATEGORICAL = ("c_flag", "c_status", "c_rare")

# A deterministic stand-in for model output, so evaluation has an exact oracle.
SCORED = (
    ("target", "CASE WHEN l_quantity > 30 AND l_discount >= 0.05 THEN 1 "
               "WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END"),
    ("prob", "ROUND(0.6 * l_quantity / 50 + 4 * l_discount, 4)"),
)


def _exprs(cols, dialect: str) -> list[str]:
    return [f"{expr.format(ts=_TS[dialect])} AS {alias}" for alias, expr in cols]


def view_sql(cols, dialect: str = "duckdb", source: str = "lineitem") -> str:
    return f"SELECT {', '.join(_exprs(cols, dialect))} FROM {source}"


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(*_exprs(STATEMENTS, "spark"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(*_exprs(SCORED, "spark"))


def statement_roles(df: DataFrame) -> Roles:
    return Roles.of(
        df, id_cols=STATEMENT_ID_COLS, label_col=STATEMENT_LABEL,
        categorical=STATEMENT_CATEGORICAL,
    )


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause defining the named fixture views for DuckDB."""
    views = {"statements": STATEMENTS, "scored": SCORED, "wide": WIDE}
    body = ",\n".join(f"{n} AS ({view_sql(views[n])})" for n in names)
    return f"WITH {body}\n"


# --- wide_statements: the reference's width (~190 features), built by rule ---
#
# 179 numeric features n_000..n_178 over the lineitem measures, with NULL and
# NaN injected by key rules, four sparse columns, and the 11 default
# categorical names (every third one an integer code), plus the default id
# and label columns.  All-missing rows are the same key rule as above.

WIDE_NUMERIC = 179
_BASES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def _wide_numeric(k: int) -> tuple[str, str]:
    base = _BASES[k % len(_BASES)]
    integer = base == "l_linenumber"
    value = f"l_linenumber + {k}" if integer else f"{base} * {1 + k / 1000:.3f}"
    arms = ["WHEN l_partkey % 97 = 5 THEN NULL"]
    if k % 45 == 7:
        arms.append("WHEN l_partkey % 50 <> 1 THEN NULL")
    if not integer:
        arms.append(f"WHEN (l_suppkey + {k}) % 29 = 0 THEN CAST('NaN' AS DOUBLE)")
    arms.append(f"WHEN (l_partkey + {k}) % {5 + k % 13} = 0 THEN NULL")
    return f"n_{k:03d}", f"CASE {' '.join(arms)} ELSE {value} END"


def _wide_categorical(j: int, name: str) -> tuple[str, str]:
    value = ("l_returnflag", "l_linestatus", f"l_linenumber % {3 + j}")[j % 3]
    arms = ["WHEN l_partkey % 97 = 5 THEN NULL", f"WHEN (l_suppkey + {j}) % {7 + j} = 0 THEN NULL"]
    if j == 10:
        arms.insert(1, "WHEN l_partkey % 40 <> 3 THEN NULL")
    return name, f"CASE {' '.join(arms)} ELSE {value} END"


def _wide_columns():
    from riskfold.roles import DEFAULT_CATEGORICAL_COLS

    cols = [
        ("customer_ID", "CAST(l_orderkey AS STRING)"),
        ("date", "CAST(CAST(l_shipdate AS DATE) AS STRING)"),
        ("test", "l_shipdate >= {ts}"),
        ("target", dict(STATEMENTS)["target"]),
    ]
    cols += [_wide_numeric(k) for k in range(WIDE_NUMERIC)]
    cols += [_wide_categorical(j, n) for j, n in enumerate(DEFAULT_CATEGORICAL_COLS)]
    return tuple(cols)


WIDE = _wide_columns()


def wide_statements_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide view, derived while it is read: nothing is written.

    The all-missing row filter moves down to the scan and holds every CASE
    expression, which is too long for one generated method.  Spark then leaves
    whole-stage code for that filter (it logs so) and splits its code instead.
    """
    return read_table(spark, sf_dir, "lineitem").selectExpr(*_exprs(WIDE, "spark"))


#: What :func:`wide_statements_by_price` orders by: prices, then the other columns, so one price's rows are divided too.
WIDE_ORDER = ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_returnflag", "l_linestatus",
              "l_partkey", "l_suppkey", "l_orderkey", "l_shipdate")


def wide_statements_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the wide view in the order of their prices, for a result that is written.

    36 of its numbers are multiples of the price, the one measure of many
    values; in any order they are most of the written table.  Equal prices that
    stand together are written once and counted.  The rows are ordered as
    ``lineitem`` has them, before the wide cells are derived.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.repartitionByRange(*WIDE_ORDER).sortWithinPartitions(*WIDE_ORDER).selectExpr(*_exprs(WIDE, "spark"))


def fingerprint(spark: SparkSession, sf_dir: str, *more) -> str:
    """Identifies what is derived from ``lineitem``: its files, the views and ``more``.

    Name, length and modification time of every file come through Hadoop's
    FileSystem, so a changed input on any store, or a changed file within a
    folder, gives another fingerprint.
    """
    import hashlib

    from riskfold.session import file_stamps

    stamps = file_stamps(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    views = view_sql(STATEMENTS) + view_sql(WIDE) + view_sql(SCORED)
    return hashlib.sha256(repr((stamps, views, more)).encode()).hexdigest()[:16]


def wide_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide view as a Parquet table of plain columns, for model fits.

    A pipeline's many projections over ~190 CASE expressions are more than
    Catalyst should carry; a real statement table arrives as plain columns.
    One version is kept for the same input files and rules.  Queries that pass
    over the rows once or twice take :func:`wide_statements_view`: deriving the
    cells costs less than writing and reading them, row by row, in a table of
    more columns than Spark's vectorised reader takes.
    """
    from riskfold.session import written_table

    return written_table(spark, f"wide-{fingerprint(spark, sf_dir)}", lambda: wide_statements_view(spark, sf_dir))


def wide_roles(df: DataFrame) -> Roles:
    """The library defaults: customer_ID/date/test, target, the 11 categorical names."""
    return Roles.of(df)
