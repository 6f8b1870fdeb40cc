"""riskfold: Spark-native preparation, training, evaluation and scoring of
wide tabular risk data.

Everything is expressed with DataFrames, Spark ML pipelines and Structured
Streaming; the caller owns the SparkSession.  The user-level jobs:

* ``profile(df, roles)``        -> long null/NaN profile with percentages
* ``clean(df, roles)``          -> rows with a feature present, sparse columns dropped
* ``fit(df, roles, preset)``    -> fitted PipelineModel + hold-out split
* ``evaluate(scored)``          -> one-row report (AUC, confusion, rates)
* ``score_requests(req, model)``-> customer_id, prediction, probability, risk_level
* ``start_scoring_stream(...)`` -> the same scoring on a stream
"""

from riskfold.operators.clean import clean
from riskfold.operators.evaluate import metric_report as evaluate
from riskfold.operators.profile import null_nan_percent as profile
from riskfold.plans.score import score, score_requests
from riskfold.plans.train import PRESETS, fit, load, save
from riskfold.roles import Roles
from riskfold.streaming.score_stream import read_committed, start_scoring_stream

__all__ = [
    "PRESETS", "Roles", "clean", "evaluate", "fit", "load", "profile", "read_committed", "save", "score",
    "score_requests", "start_scoring_stream",
]
__version__ = "0.1.0"
