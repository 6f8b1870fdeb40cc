"""Missing-value expressions.

Numeric missing is ``NULL or NaN``; every other role is missing when ``NULL``.
Only floating columns can hold NaN, so only they get the NaN test (an integer
or string column never needs a cast to double for it).

Per-column expressions are built as SQL text and parsed once in the JVM:
for a ~190-column table this is one call instead of over a thousand Py4J
round trips, and the resulting plan is the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskfold.roles import Roles


def q(name: str) -> str:
    """Backtick-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit_str(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def present_sql(name: str, floating: bool) -> str:
    """The value when present, NULL when missing (NaN folded into NULL)."""
    return f"nanvl({q(name)}, CAST(NULL AS DOUBLE))" if floating else q(name)


def missing_sql(name: str, floating: bool) -> str:
    return f"({q(name)} IS NULL OR isnan({q(name)}))" if floating else f"({q(name)} IS NULL)"


def present_value(name: str, floating: bool) -> Column:
    return F.expr(present_sql(name, floating))


def is_missing(name: str, floating: bool) -> Column:
    return F.expr(missing_sql(name, floating))


def any_feature_present_sql(roles: Roles) -> str | None:
    """SQL for "at least one feature is present"; ``None`` with no features.

    One flat ``coalesce`` for each feature type: it is the negation of "every
    feature is missing", needs no cast and no coercion, and no later
    expression repeats one of its arguments.
    """
    by_type: dict[str, list[str]] = {}
    types = dict(roles.types)
    for c in roles.features:
        by_type.setdefault(types.get(c, "double" if c in roles.floating else c), []).append(c)
    parts = []
    for kind, names in by_type.items():
        null = "CAST(NULL AS FLOAT)" if kind == "float" else "CAST(NULL AS DOUBLE)"
        values = [f"nanvl({q(c)}, {null})" if c in roles.floating else q(c) for c in names]
        parts.append(f"coalesce({', '.join(values)}) IS NOT NULL")
    if not parts:
        return None
    return " OR ".join(f"({p})" for p in parts)


def any_feature_present(roles: Roles) -> Column | None:
    sql = any_feature_present_sql(roles)
    return None if sql is None else F.expr(sql)
