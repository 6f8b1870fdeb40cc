"""Score-derived expressions: threshold labels and risk bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk band cut points (low below 0.3, medium below 0.7, else high)
# and the default decision threshold.
LOW_BELOW = 0.3
MEDIUM_BELOW = 0.7
DEFAULT_THRESHOLD = 0.5


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known_score(prob) -> Column:
    """The score, or NULL where it is NULL or NaN: a NaN is no score."""
    return F.nanvl(_col(prob).cast("double"), F.lit(None).cast("double"))


def threshold_label(prob, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """1 when ``prob >= threshold`` (inclusive), else 0; NULL and NaN give NULL."""
    return (known_score(prob) >= F.lit(threshold)).cast("int")


def risk_level(prob, low_below: float = LOW_BELOW, medium_below: float = MEDIUM_BELOW) -> Column:
    """'low' below 0.3, 'medium' below 0.7, 'high' from 0.7 up (0.7 is high); NULL and NaN give NULL."""
    p = known_score(prob)
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p < low_below, "low")
        .when(p < medium_below, "medium")
        .otherwise("high")
    )
