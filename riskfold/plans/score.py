"""Bulk scoring: requests (or typed rows) in, ``customer_id, prediction,
probability, risk_level`` out, in one job for any number of rows.

The fitted PipelineModel carries the casts, imputation means, category
indices, scaler and trees, so serving applies exactly what training learned.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from riskfold.functions.scoring import DEFAULT_THRESHOLD, risk_level, threshold_label
from riskfold.plans.train import model_feature_columns, model_input, probability_of_default
from riskfold.sources.requests import request_columns, split_requests


def score(df: DataFrame, model: PipelineModel, id_col: str = "customer_id",
          threshold: float = DEFAULT_THRESHOLD, num_partitions: int | None = None) -> DataFrame:
    """Scores of every row; features that ``df`` lacks count as missing.

    Needs no exchange.  ``num_partitions`` deals the rows out first, for an
    input that arrives in fewer splits than there are cores.
    """
    rows = df.repartition(num_partitions) if num_partitions else df
    p = probability_of_default()
    return model.transform(model_input(model, rows)).select(
        id_col,
        threshold_label(p, threshold).alias("prediction"),
        p.alias("probability"),
        risk_level(p).alias("risk_level"),
    )


def score_requests(requests: DataFrame, model: PipelineModel, threshold: float = DEFAULT_THRESHOLD,
                   num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests, rejected requests with reason)."""
    numeric, categorical = model_feature_columns(model)
    valid, rejected = split_requests(requests)
    typed = request_columns(valid, numeric, categorical)
    return score(typed, model, threshold=threshold, num_partitions=num_partitions), rejected
