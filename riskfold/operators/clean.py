"""Cleaning: drop rows whose features are all missing, then sparse columns.

Two scans in total: one aggregate for the missing rates (over the rows that
survive the row filter) and the final projection.  Nothing is cached: the
row filter is pushed to the scan and the dropped columns are pruned from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.operators.profile import _long, missing_counts_row, present_counts_row
from riskfold.roles import Roles

DEFAULT_MISSING_THRESHOLD = 0.95  # fixed value


def drop_all_missing_rows(df: DataFrame, roles: Roles) -> DataFrame:
    """Keep rows with at least one feature present; no features keeps all."""
    from riskfold.functions.missing import any_feature_present

    cond = any_feature_present(roles)
    return df if cond is None else df.where(cond)


def missing_rates(df: DataFrame, roles: Roles) -> DataFrame:
    """Long table ``(column_name, role, n_rows, n_missing, missing_rate)`` over features."""
    nan_cols = [c for c in roles.numeric if c in roles.floating]
    wide = missing_counts_row(df, roles.features, nan_cols)
    return _long(wide, roles.features, roles).withColumn(
        "missing_rate", F.try_divide(F.col("n_missing"), F.col("n_rows"))
    )


def feature_stats(df: DataFrame, roles: Roles, moments: bool = False) -> dict:
    """One row of one pass: ``n_rows`` and the present count of each feature.

    With ``moments`` also mean and sample variance of the present values of
    each numeric feature, ``__mean__<col>`` and ``__var__<col>``.
    """
    from riskfold.functions.missing import present_sql, q

    nan_cols = [c for c in roles.numeric if c in roles.floating]
    extra = []
    for c in roles.numeric if moments else ():
        v = f"CAST({present_sql(c, c in roles.floating)} AS DOUBLE)"
        extra += [f"avg({v}) AS {q('__mean__' + c)}", f"var_samp({v}) AS {q('__var__' + c)}"]
    return present_counts_row(df, roles.features, nan_cols, extra).first().asDict()


def _sparse(stats: dict, roles: Roles, threshold: float) -> list[str]:
    n = stats["n_rows"]
    return [c for c in roles.features if (n - stats[c]) / n > threshold] if n else []


def sparse_columns(
    df: DataFrame, roles: Roles, threshold: float = DEFAULT_MISSING_THRESHOLD
) -> tuple[list[str], int]:
    """Features whose missing rate is strictly above ``threshold``, and the row count.

    Brings one row (one number per feature) to the driver.  An empty table has
    no rates and drops nothing.
    """
    if not roles.features:
        return [], 0
    stats = feature_stats(df, roles)
    return _sparse(stats, roles, threshold), stats["n_rows"]


def drop_sparse_columns(
    df: DataFrame, roles: Roles, threshold: float = DEFAULT_MISSING_THRESHOLD
) -> tuple[DataFrame, list[str], Roles]:
    dropped, _ = sparse_columns(df, roles, threshold)
    out = df.drop(*dropped)
    return out, dropped, roles.refresh(out.schema)


@dataclass
class Cleaned:
    df: DataFrame
    roles: Roles
    dropped: list[str]
    n_rows: int
    stats: dict = field(default_factory=dict)  # see feature_stats


def clean(df: DataFrame, roles: Roles, threshold: float = DEFAULT_MISSING_THRESHOLD, moments: bool = False) -> Cleaned:
    """Row filter, then sparse-column drop with the filtered row count as denominator.

    ``moments`` adds the numeric means and variances to the same pass, so an
    imputation or scaling of the cleaned table needs no pass of its own.
    """
    rows = drop_all_missing_rows(df, roles)
    stats = feature_stats(rows, roles, moments) if roles.features else {"n_rows": 0}
    dropped = _sparse(stats, roles, threshold)
    out = rows.drop(*dropped)
    return Cleaned(out, roles.refresh(out.schema), dropped, stats["n_rows"], stats)
