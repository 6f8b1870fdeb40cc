"""Evaluation of scores against labels, on all rows.

* confusion counts and the derived rates: one aggregate of conditional
  counts (partial aggregation, one row per task through the shuffle);
* exact ROC curve and AUC: one grouped pass to distinct scores, then the
  range-partitioned running totals of :mod:`riskfold.operators.prefix`;
  AUC = sum over scores of neg * (tp_at_or_above - pos / 2) / (P * N),
  i.e. the Mann-Whitney statistic with half credit for ties;
* histogram per class: bins on [0, 1] or between the class's own extremes.

One rule holds throughout: rows with label 1 are positive, with label 0
negative, all others are not evaluated; a score that is NULL or NaN is no
score, and such rows are counted as ``n_unscored``, in no cell.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.functions.scoring import DEFAULT_THRESHOLD, known_score, threshold_label
from riskfold.operators.prefix import running_totals
from riskfold.session import shared_root

# Fixed value: the factor the original report applies to AUC for its
# "estimated private leaderboard" line.
LB_FACTOR = 0.855
HIST_BINS = 60  # fixed value


def _div0(num: Column, den: Column) -> Column:
    """num / den, 0.0 when the denominator is 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _labelled(df: DataFrame, label_col: str) -> DataFrame:
    return df.where(F.col(label_col).isin(0, 1))


def confusion_counts(df: DataFrame, label_col: str = "target", score_col: str | None = "prob",
                     threshold: float = DEFAULT_THRESHOLD, pred_col: str | None = None) -> DataFrame:
    """One row ``tp, tn, fp, fn, n_rows, n_unscored``; predictions from ``pred_col`` or ``score >= threshold``.

    ``n_rows`` counts the labelled rows: the four cells and the unscored.
    """
    y = F.col(label_col)
    pred = F.col(pred_col) if pred_col else threshold_label(score_col, threshold)
    return _labelled(df, label_col).agg(
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(pred.isNull()).alias("n_unscored"),
    )


def _rates(tp, tn, fp, fn) -> list[Column]:
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        _div0(2 * precision * recall, precision + recall).alias("f1_score"),
        _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _div0(tn, tn + fp).alias("specificity"),
        _div0(fp, fp + tn).alias("false_alarm_rate"),
        (F.lit(1.0) - recall).alias("miss_rate"),
    ]


def classification_metrics(df: DataFrame, label_col: str = "target", score_col: str | None = "prob",
                           threshold: float = DEFAULT_THRESHOLD, pred_col: str | None = None) -> DataFrame:
    cm = confusion_counts(df, label_col, score_col, threshold, pred_col)
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return cm.select("tp", "tn", "fp", "fn", "n_unscored", *_rates(tp, tn, fp, fn))


def confusion_percent(df: DataFrame, label_col: str = "target", score_col: str | None = "prob",
                      threshold: float = DEFAULT_THRESHOLD, pred_col: str | None = None) -> DataFrame:
    cm = confusion_counts(df, label_col, score_col, threshold, pred_col)
    n = F.col("n_rows")
    return cm.select(
        "tp", "tn", "fp", "fn", "n_rows", "n_unscored",
        *[(F.try_divide(F.col(c), n) * 100).alias(f"{c}_pct") for c in ("tp", "tn", "fp", "fn")],
    )


def score_points(df: DataFrame, label_col: str = "target", score_col: str = "prob",
                 decimals: int | None = None, unscored: bool = False) -> DataFrame:
    """One row per distinct score: ``score, pos, neg`` (partial aggregation absorbs hot scores).

    ``decimals`` (default: exact) rounds scores first, bounding the number of
    ROC points for continuous scores; every row still counts.  ``unscored``
    adds a point with NULL score for the rows without one.
    """
    y = F.col(label_col)
    s = known_score(score_col)
    if decimals is not None:
        s = F.round(s, decimals)
    points = _labelled(df, label_col).groupBy(s.alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    return points if unscored else points.where(F.col("score").isNotNull())


def roc_curve(df: DataFrame, label_col: str = "target", score_col: str = "prob",
              n_ranges: int | None = None, decimals: int | None = None) -> DataFrame:
    """ROC point at every distinct score s (predict positive when score >= s).

    Columns: ``score, pos, neg, tp, fp, tpr, fpr, n_pos, n_neg``.
    """
    return _roc(score_points(df, label_col, score_col, decimals), n_ranges)


def _roc(points: DataFrame, n_ranges: int | None, materialise: bool = True) -> DataFrame:
    pts = running_totals(points, "score", ["pos", "neg"], descending=True, n_ranges=n_ranges, materialise=materialise)
    return pts.select(
        "score", "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
        F.try_divide(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        F.col("total_pos").alias("n_pos"), F.col("total_neg").alias("n_neg"),
    )


def _auc_sum(roc: DataFrame) -> Column:
    return F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))


def auc_exact(df: DataFrame, label_col: str = "target", score_col: str = "prob",
              n_ranges: int | None = None, decimals: int | None = None) -> DataFrame:
    """One row ``auc, n_pos, n_neg`` (AUC NULL when a class is absent)."""
    roc = roc_curve(df, label_col, score_col, n_ranges, decimals)
    return roc.agg(
        F.try_divide(_auc_sum(roc), F.max("n_pos").cast("double") * F.max("n_neg")).alias("auc"),
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
    )


def metric_report(df: DataFrame, label_col: str = "target", score_col: str = "prob",
                  threshold: float = DEFAULT_THRESHOLD, lb_factor: float = LB_FACTOR,
                  n_ranges: int | None = None, decimals: int | None = None) -> DataFrame:
    """All headline metrics in one row, from one pass over the ROC points.

    The confusion counts at ``threshold`` are sums over the distinct-score
    rows, so no second scan of the scored table is needed; the points are
    checkpointed once, and the unscored rows are one of them.
    """
    shared_root(df.sparkSession)
    points = score_points(df, label_col, score_col, decimals, unscored=True).checkpoint(eager=True)
    known = F.col("score").isNotNull()
    roc = _roc(points.where(known), n_ranges, materialise=False).unionByName(points.where(~known), allowMissingColumns=True)
    above = F.col("score") >= F.lit(threshold)
    agg = roc.agg(
        F.try_divide(_auc_sum(roc), F.max("n_pos").cast("double") * F.max("n_neg")).alias("auc"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~above, F.col("pos")).otherwise(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~known, F.col("pos") + F.col("neg"))), F.lit(0)).alias("n_unscored"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return agg.select(
        "auc", (F.col("auc") * lb_factor).alias("auc_scaled"), F.lit(threshold).alias("threshold"),
        *[F.coalesce(c, F.lit(0)).alias(n) for n, c in (("tp", tp), ("tn", tn), ("fp", fp), ("fn", fn))],
        "n_unscored",
        *_rates(*[F.coalesce(c, F.lit(0)) for c in (tp, tn, fp, fn)]),
    )


def score_histogram(df: DataFrame, label_col: str = "target", score_col: str = "prob",
                    bins: int = HIST_BINS, own_edges: bool = False) -> DataFrame:
    """Per class and bin: count and density ``n / (N_class * width)``; empty bins count 0.

    The bins divide [0, 1], or with ``own_edges`` the span between the class's
    smallest and largest score (one more aggregate, a row a class).
    """
    p = known_score(score_col)
    scored = _labelled(df, label_col).where(p.isNotNull()).select(F.col(label_col), p.alias("p"))
    if own_edges:
        edges = scored.groupBy(label_col).agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
        # a class with one score only gets bins around it
        edges = edges.select(
            label_col, F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
        scored = scored.join(F.broadcast(edges), label_col)  # two rows
    else:
        scored = scored.withColumns({"lo": F.lit(0.0), "hi": F.lit(1.0)})
    at = F.floor((F.col("p") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    b = F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = scored.groupBy(F.col(label_col), "lo", "hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # a map of the filled bins a class, then every bin
    by_class = counts.groupBy(label_col, "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"), F.sum("n").alias("n_class"))
    every = by_class.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    n = F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0).cast("long"))
    return every.select(
        label_col, "bin", n.alias("n"), (n / (F.col("n_class") * width)).alias("density"),
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"), (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
    )


def output_contract(df: DataFrame, pred_col: str = "prediction", prob_col: str = "probability") -> DataFrame:
    """Counts of rows breaking the response contract (expected zero)."""
    pred, prob = F.col(pred_col), F.col(prob_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(pred.isNull() | ~pred.isin(0, 1)).alias("bad_prediction"),
        F.count_if(prob.isNull() | F.isnan(prob) | (prob < 0) | (prob > 1)).alias("bad_probability"),
    )


def evaluator_auc(df: DataFrame, label_col: str = "target", raw_col: str = "prob",
                  num_bins: int = 1000) -> float:
    """Spark's evaluator (``num_bins=0`` is exact; the default down-samples the curve)."""
    ev = BinaryClassificationEvaluator(
        labelCol=label_col, rawPredictionCol=raw_col, metricName="areaUnderROC", numBins=num_bins,
    )
    data = _labelled(df, label_col).withColumn(label_col, F.col(label_col).cast("double"))
    return float(ev.evaluate(data))
