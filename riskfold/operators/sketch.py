"""A mergeable sketch of scores, and the area under the ROC curve with its error bound.

The unit interval is cut into ``2**bits`` equal cells.  A sketch has, for each
cell that is not empty, the positive and negative rows, and the least and the
greatest score seen in it.  Its size is fixed by ``bits`` whatever the number
of rows or of distinct scores; sketches of disjoint rows merge by adding up
counts and taking the outer ends.  It comes from one aggregate, with no sort
and no checkpoint.

Pairs of a positive and a negative row in different cells are ordered rightly.
Pairs within a cell are counted as ties; that is exact where the cell holds a
single score, however many rows have it, and else off by half of the pair at
most.  So the exact area lies within

    error_bound = sum over cells with two scores or more of pos * neg / 2 / (P * N)

of the estimate, a bound that is computed from the sketch itself and holds for
every input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfold.functions.scoring import known_score

BITS = 12
SCHEMA = "cell int, pos long, neg long, lo double, hi double"


def cell_of(score: Column, bits: int = BITS) -> Column:
    """The cell of a score; scores outside of [0, 1] belong to the first or the last one."""
    n = 1 << bits
    inside = F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))
    return F.when(score.isNotNull(), F.least(F.floor(inside * n), F.lit(n - 1)).cast("int"))


def score_sketch(df: DataFrame, label_col: str = "target", score_col: str = "prob", bits: int = BITS,
                 by: list[str] | None = None) -> DataFrame:
    """``cell, pos, neg, lo, hi`` of all rows with label 0 or 1, or of each group of ``by`` columns.

    Cell NULL counts the rows without a score (NULL or NaN).
    """
    y, s = F.col(label_col), known_score(score_col).cast("double")
    rows = df.where(y.isin(0, 1)).select(*(by or []), y.alias("__y"), s.alias("__s"))
    return rows.groupBy(*(by or []), cell_of(F.col("__s"), bits).alias("cell")).agg(
        F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") == 0).alias("neg"),
        F.min("__s").alias("lo"), F.max("__s").alias("hi"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One sketch of all rows, or of each group of ``by``; the sketches are of disjoint rows and equal bits."""
    return sketches.groupBy(*(by or []), "cell").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def auc_of(sketch: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``auc, error_bound, n_pos, n_neg, n_unscored`` of a sketch, or of each group; NULL where a class is absent.

    The window spans the cells of one sketch, a number that ``bits`` fixes.
    """
    by = list(by or [])
    order = Window.partitionBy(*by).orderBy(F.col("cell").asc_nulls_first())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("cell").isNotNull()
    cells = sketch.select(
        *by, known.alias("__known"), F.col("pos").alias("__p"), F.col("neg").alias("__n"),
        F.coalesce(F.sum(F.when(known, F.col("neg"))).over(below), F.lit(0)).alias("__below"),
        (F.col("lo") < F.col("hi")).alias("__mixed"))
    # products of counts: as doubles, which hold what 64-bit integers do not
    p, n, under = (F.col(c).cast("double") for c in ("__p", "__n", "__below"))
    sums = cells.groupBy(*by).agg(
        F.sum(F.when(F.col("__known"), F.col("__p")).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("__known"), F.col("__n")).otherwise(0)).alias("n_neg"),
        F.sum(F.when(F.col("__known"), 0).otherwise(F.col("__p") + F.col("__n"))).alias("n_unscored"),
        F.sum(F.when(F.col("__known"), p * (under + n / 2))).alias("__won"),
        F.sum(F.when(F.col("__known") & F.col("__mixed"), p * n / 2).otherwise(0.0)).alias("__open"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    zero = lambda c: c if by else F.coalesce(c, F.lit(0))
    return sums.select(
        *by, F.try_divide(F.col("__won"), pairs).alias("auc"), F.try_divide(F.col("__open"), pairs).alias("error_bound"),
        *[zero(F.col(c)).cast("long").alias(c) for c in ("n_pos", "n_neg", "n_unscored")])


def quantiles_of(sketch: DataFrame, shares: list[float]) -> DataFrame:
    """``share, lo, hi`` for each of ``shares``: between which scores that quantile of all scored rows lies."""
    known = sketch.where(F.col("cell").isNotNull()).select("lo", "hi", "cell", (F.col("pos") + F.col("neg")).alias("__n"))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a fixed number of cells
    total = Window.partitionBy()
    cells = known.select("lo", "hi", F.sum("__n").over(upto).alias("__upto"), "__n", F.sum("__n").over(total).alias("__all"))
    wanted = sketch.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    # the row that has this rank, from 1
    rank = F.greatest(F.ceil(F.col("share") * F.col("__all")), F.lit(1))
    return cells.join(F.broadcast(wanted), (rank <= F.col("__upto")) & (rank > F.col("__upto") - F.col("__n"))).select("share", "lo", "hi")
