"""Missing-value profiling (null + NaN per column) and partition statistics.

Every profile is ONE global aggregate over the table: ``count(*)`` plus one
``count(present)`` per column, where present folds NaN into NULL for floating
columns.  Catalyst runs it as a partial aggregate in every scan task followed
by a single-row final merge, so the shuffle carries one row per task whatever
the table size; missing = rows - present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.functions.missing import lit_str, missing_sql, present_sql, q
from riskfold.roles import Roles, is_floating_type


def _floating_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if is_floating_type(f.dataType)}


def present_counts_row(df: DataFrame, columns, nan_columns=None, extra=()) -> DataFrame:
    """One wide row: ``n_rows`` and ``count(present)`` per column, one aggregate.

    ``extra`` adds further aggregate SQL expressions to the same pass.
    """
    nan_columns = _floating_columns(df) if nan_columns is None else set(nan_columns)
    return df.selectExpr(
        "count(1) AS n_rows",
        *[f"count({present_sql(c, c in nan_columns)}) AS {q(c)}" for c in columns],
        *extra,
    )


def missing_counts_row(df: DataFrame, columns, nan_columns=None) -> DataFrame:
    """One wide row: ``n_rows`` and one missing count (rows - present) per column.

    ``nan_columns`` are the columns where NaN counts as missing (default: all
    floating columns).
    """
    present = present_counts_row(df, columns, nan_columns)
    return present.selectExpr("n_rows", *[f"n_rows - {q(c)} AS {q(c)}" for c in columns])


def role_lookup_sql(columns, roles: Roles, name_col: str = "column_name") -> str:
    pairs = ", ".join(f"{lit_str(c)}, {lit_str(roles.role_of(c))}" for c in columns)
    return f"map({pairs})[{name_col}]"


def _long(wide: DataFrame, columns, roles: Roles) -> DataFrame:
    long = wide.unpivot(
        ids=["n_rows"], values=list(columns),
        variableColumnName="column_name", valueColumnName="n_missing",
    )
    return long.selectExpr(
        "column_name", f"{role_lookup_sql(columns, roles)} AS role", "n_rows", "n_missing",
    )


def null_nan_profile(df: DataFrame, roles: Roles) -> DataFrame:
    """Long table ``(column_name, role, n_rows, n_missing)`` over every column.

    Numeric columns count NULL and NaN; id, label and categorical columns
    count NULL only.
    """
    nan_cols = [c for c in roles.numeric if c in roles.floating]
    wide = missing_counts_row(df, df.columns, nan_cols)
    return _long(wide, df.columns, roles)


def null_nan_percent(df: DataFrame, roles: Roles) -> DataFrame:
    """:func:`null_nan_profile` plus ``pct_missing = n_missing / n_rows * 100``."""
    prof = null_nan_profile(df, roles)
    return prof.withColumn(
        "pct_missing", F.try_divide(F.col("n_missing"), F.col("n_rows")) * 100
    )


def missing_flags(df: DataFrame, roles: Roles, keep=None) -> DataFrame:
    """Row-level 0/1 missing flags ``<col>_missing`` for every feature and the label."""
    keep = list(roles.id_cols) if keep is None else list(keep)
    cols = list(roles.features) + ([roles.label_col] if roles.label_col else [])
    return df.selectExpr(
        *[q(c) for c in keep],
        *[f"CAST({missing_sql(c, c in roles.floating)} AS INT) AS {q(c + '_missing')}" for c in cols],
    )


def partition_stats(df: DataFrame) -> DataFrame:
    """Rows per partition of ``df`` (real sizes, so skew is visible)."""
    return (
        df.select(F.spark_partition_id().alias("partition_id"))
        .groupBy("partition_id").agg(F.count(F.lit(1)).alias("n_rows"))
    )
