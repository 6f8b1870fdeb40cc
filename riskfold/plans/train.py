"""Training: clean -> label -> hash split -> weights -> one Pipeline fit.

All preparation stages and the GBT classifier sit in one Pipeline fitted on
the labelled training rows only, so nothing is learned from the hold-out or
from unlabelled rows.  The training projection is persisted once
(MEMORY_AND_DISK) before the fit because every stage fit and every boosting
round re-reads it; it is unpersisted afterwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.functions.scoring import DEFAULT_THRESHOLD, threshold_label
from riskfold.operators import draws
from riskfold.operators.balance import class_weights, with_class_weight
from riskfold.operators.clean import DEFAULT_MISSING_THRESHOLD, clean
from riskfold.operators.pool import pooled
from riskfold.operators.prep import CAT, FEATURES, NUM, feature_input_cols, numeric_input, preparation_stages
from riskfold.operators.split import DEFAULT_SEED, DEFAULT_TRAIN_PCT, hash_split, random_split
from riskfold.roles import Roles
from riskfold.session import path_exists, publish, versions
from riskfold.sources.bundles import BundleError, verify, write_manifest

# The two training settings of the original pipeline (the
# notebook's and the script's), plus a small setting for tests and benchmarks.
PRESETS = {
    "notebook": dict(maxDepth=6, maxIter=60, stepSize=0.1, subsamplingRate=0.8, maxBins=32,
                     weighting="inverse"),
    "script": dict(maxDepth=5, maxIter=100, stepSize=0.1, subsamplingRate=1.0, maxBins=32,
                   weighting="balanced"),
    "quick": dict(maxDepth=4, maxIter=10, stepSize=0.1, subsamplingRate=1.0, maxBins=32,
                  weighting="balanced"),
}
WEIGHT_COL = "class_weight"


@dataclass
class Trained:
    model: PipelineModel
    roles: Roles
    dropped: list
    weights: dict
    train: DataFrame
    test: DataFrame
    preset: str
    params: dict = field(default_factory=dict)


def labelled(df: DataFrame, label_col: str) -> DataFrame:
    """Label cast to double, rows without a label dropped (pushed to the scan)."""
    return df.where(F.col(label_col).isNotNull()).withColumn(label_col, F.col(label_col).cast("double"))


def gbt(label_col: str, preset: str = "script", seed: int = DEFAULT_SEED, weight_col: str = WEIGHT_COL,
        checkpoint_every: int = 10, **overrides) -> GBTClassifier:
    """GBT with a preset; the boosting state is checkpointed every ``checkpoint_every`` rounds (-1: never).

    Checkpoints go to the shared checkpoint folder and bound the lineage an
    executor loss has to replay.
    """
    p = {k: v for k, v in PRESETS[preset].items() if k != "weighting"}
    p.update(overrides)
    p.setdefault("checkpointInterval", checkpoint_every)
    return GBTClassifier(featuresCol=FEATURES, labelCol=label_col, weightCol=weight_col, seed=seed, **p)


def build_pipeline(roles: Roles, preset: str = "script", seed: int = DEFAULT_SEED, **overrides) -> Pipeline:
    return Pipeline(stages=[*preparation_stages(roles), gbt(roles.label_col, preset, seed, **overrides)])


def fit_pipeline(df: DataFrame, roles: Roles, preset: str = "script", seed: int = DEFAULT_SEED, pool: bool = True,
                 num_partitions: int | None = None, deal=None, **overrides) -> PipelineModel:
    """Fit :func:`build_pipeline` on ``df``; equal rows of bins are boosted as one weighted row.

    See :mod:`riskfold.operators.pool`, and :mod:`riskfold.operators.draws` for
    a fit that draws rows anew in each round, whose cells go to
    ``num_partitions``.  A fit that counts the rows of a node needs them one by
    one.  ``deal`` lays out the rows for a fit that goes over them.
    """
    pipeline = build_pipeline(roles, preset, seed, **overrides)
    *steps, trees = pipeline.getStages()
    if pool and draws.can_draw(trees):
        model = _fit_drawn(df, roles, steps, trees, num_partitions)
        if model is not None:
            return model
    if deal is not None:
        with deal(df) as rows:
            return pipeline.fit(rows)
    if not pool or trees.getSubsamplingRate() < 1 or trees.getMinInstancesPerNode() > 1:
        return pipeline.fit(df)
    prepared = Pipeline(stages=steps).fit(df)
    ready = prepared.transform(df)
    cells = pooled(ready, FEATURES, roles.label_col, WEIGHT_COL, len(feature_input_cols(roles)), trees.getMaxBins())
    if cells is None:
        return PipelineModel([*prepared.stages, trees.fit(ready)])
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*prepared.stages, trees.fit(cells)])
    finally:
        cells.unpersist()


def _fit_drawn(df: DataFrame, roles: Roles, steps, trees, num_partitions: int | None) -> PipelineModel | None:
    """The fit of ``trees`` on cells of equal rows, or None where the rows are to be drawn one by one."""
    n = df.count()
    if n < draws.LEAST_ROWS:
        return None
    prepared = Pipeline(stages=steps).fit(df)
    means, n_labels = {}, []
    for st in prepared.stages:
        if st.__class__.__name__ == "ImputerModel":
            row = st.surrogateDF.first()
            means = {c: row[numeric_input(roles, c)] for c in roles.numeric}
        elif st.__class__.__name__ == "StringIndexerModel":
            n_labels = [len(x) for x in st.labelsArray]
    cells = draws.counted(df, n, roles, WEIGHT_COL, means, n_labels, trees.getMaxBins())
    if cells is None:
        return None
    spark = df.sparkSession
    ready = prepared.transform(draws.dealt_cells(cells, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return PipelineModel([*prepared.stages, draws.boosted(ready, trees)])


def check_categories(df: DataFrame, columns, most: int) -> None:
    """Refuse categorical columns with more than ``most`` different values (exact counts, one pass)."""
    if not columns:
        return
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first().asDict()
    too_many = {c: n for c, n in counts.items() if n > most}
    if too_many:
        raise ValueError(f"categorical columns with more than {most} values: {too_many}; "
                         "the string indexer keeps every value on the driver")


def dealt(df: DataFrame, row_key: Sequence[str], num_partitions: int, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``df`` in a layout that depends on the rows alone.

    Rows that tie in the key are ordered by the columns; those that tie in
    these too are the same to the fit.  The number of partitions is stated, so
    adaptive execution leaves it as it is.
    """
    rest = [c for c in columns if c not in row_key]
    order = [F.col(f"`{c}`") for c in (*row_key, *rest)]
    return df.select(*order).repartition(num_partitions, *order[:len(row_key)]).sortWithinPartitions(*order).select(
        *[F.col(f"`{c}`") for c in columns])


def _dealer(row_key: Sequence[str], num_partitions: int, columns: Sequence[str]):
    """A context that has its rows :func:`dealt` and persisted."""

    @contextmanager
    def deal(df: DataFrame):
        rows = dealt(df, row_key, num_partitions, columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield rows
        finally:
            rows.unpersist()

    return deal


def model_digest(model: PipelineModel, digits: int = 8) -> str:
    """SHA-256 of the trees: structure, split features, and all numbers to ``digits`` decimals.

    The last bits of a sum depend on the order in which tasks finish; features
    and predictions are of the size of 1.
    """
    gbt_model = model.stages[-1]
    text = re.sub(r"uid\s*=\s*\S+", "", gbt_model.toDebugString)
    text = re.sub(r"-?\d+\.\d+(?:E-?\d+)?", lambda m: f"{round(float(m[0]), digits) + 0.0:.{digits}f}", text)
    weights = ",".join(f"{w:.{digits}f}" for w in gbt_model.treeWeights)
    return hashlib.sha256(f"{text}\n{weights}".encode()).hexdigest()


def fit(df: DataFrame, roles: Roles, preset: str = "script", id_col: str | None = None,
        seed: int = DEFAULT_SEED, train_pct: int = DEFAULT_TRAIN_PCT, split: str = "hash",
        missing_threshold: float = DEFAULT_MISSING_THRESHOLD, num_partitions: int | None = None,
        max_categories: int | None = None, row_key: Sequence[str] | None = None, **overrides) -> Trained:
    """Clean, split, weight and fit; returns the fitted PipelineModel and the splits.

    ``num_partitions`` deals the training rows out anew; by default they stay
    as the scan reads them.  Row subsampling and the search for splits draw
    rows by partition and place, so the same rows in another layout give
    another model.  ``row_key`` (columns) with ``num_partitions`` makes the fit
    independent of the layout: rows go to partitions by a hash of the key and
    are sorted inside by the key, then by all that the fit reads.
    ``max_categories`` refuses categorical columns with more values, of which
    the string indexer keeps all on the driver; by default none is refused.
    """
    if roles.label_col is None:
        raise ValueError("no label column")
    cleaned = clean(df, roles, missing_threshold)
    roles = cleaned.roles
    lab = labelled(cleaned.df, roles.label_col)
    if split == "hash":
        train, test = hash_split(lab, id_col or roles.id_cols[0], train_pct, seed)
    else:
        train, test = random_split(lab, (train_pct / 100, 1 - train_pct / 100), seed)
    method = PRESETS[preset]["weighting"]
    needed = [roles.label_col, *roles.numeric, *roles.categorical]
    # Persist the narrow training projection first: the class-weight count
    # fills the cache in the same scan, and every later fit reads the cache.
    deal = None
    if row_key is not None:
        if not num_partitions:
            raise ValueError("row_key needs num_partitions: without it the layout is the cluster's")
        base, deal = train.select(*dict.fromkeys([*row_key, *needed])), _dealer(row_key, num_partitions, [*needed, WEIGHT_COL])
    else:
        base = train.select(*needed)
        base = base.repartition(num_partitions) if num_partitions else base
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = class_weights(base, roles.label_col, method)
        if max_categories is not None:
            check_categories(base, roles.categorical, max_categories)
        train_w = with_class_weight(base, roles.label_col, weights, WEIGHT_COL)
        model = fit_pipeline(train_w, roles, preset, seed, num_partitions=num_partitions, deal=deal, **overrides)
    finally:
        base.unpersist()
    params = {k: v for k, v in PRESETS[preset].items()}
    params.update(overrides, seed=seed, train_pct=train_pct, split=split)
    return Trained(model, roles, cleaned.dropped, weights, train, test, preset, params)


def model_feature_columns(model: PipelineModel) -> tuple[list[str], list[str]]:
    """(numeric, categorical) raw input columns a fitted pipeline expects."""
    numeric, categorical = [], []
    for st in model.stages:
        java_name = st.__class__.__name__
        if java_name == "ImputerModel":
            numeric = [c.removesuffix(NUM) for c in st.getOrDefault("inputCols")]
        elif java_name == "StringIndexerModel":
            categorical = [c[: -len(CAT)] for c in st.getOrDefault("inputCols")]
    return numeric, categorical


def probability_of_default() -> F.Column:
    return vector_to_array(F.col("probability"))[1]


def model_input(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with every feature of the model: absent ones as NULL, numbers of other types as double.

    Only the plan's schema is looked at.
    """
    numeric, categorical = model_feature_columns(model)
    imputers = [st for st in model.stages if st.__class__.__name__ == "ImputerModel"]
    direct = {c for st in imputers for c in st.getOrDefault("inputCols")}  # read without a cast of the pipeline's own
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    add = {c: F.lit(None).cast("double") for c in numeric if c not in types}
    add |= {c: F.col(f"`{c}`").try_cast("double") for c in numeric if c in direct and types.get(c, "double") != "double"}
    add |= {c: F.lit(None).cast("string") for c in categorical if c not in types}
    return df.withColumns(add) if add else df


def scored_rows(model: PipelineModel, df: DataFrame, keep, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``keep`` columns + ``prob`` and ``prediction`` (``prob >= threshold``)."""
    p = probability_of_default()
    return model.transform(model_input(model, df)).select(
        *keep, p.alias("prob"), threshold_label(p, threshold).alias("prediction")
    )


def save(model: PipelineModel, base: str) -> str:
    """Save into a version of its own under ``base`` and return that path; other versions stay.

    The version's manifest names its files and the columns that the model reads.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()

    def write(path: str) -> None:
        model.write().save(path)
        write_manifest(spark, path, *model_feature_columns(model))

    return publish(spark, write, base)


def latest(path: str) -> str:
    """The newest complete version under ``path``, or ``path`` itself if it is a saved model."""
    from pyspark.sql import SparkSession

    found = versions(SparkSession.getActiveSession(), path)
    return found[-1] if found else path


def load(path: str, contents: bool = True) -> PipelineModel:
    """Load the newest version under ``path``, or the model at ``path``; raises when there is none.

    A version whose files are not those of its manifest is refused by their
    names (:class:`riskfold.sources.bundles.BundleError`); ``contents=False``
    leaves out the digests.
    """
    from pyspark.sql import SparkSession

    spark, path = SparkSession.getActiveSession(), latest(path)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path}")
    manifest = verify(spark, path, contents)
    model = PipelineModel.load(path)
    if [list(c) for c in model_feature_columns(model)] != [manifest["numeric"], manifest["categorical"]]:
        raise BundleError(path, ["the model's columns are not those of the manifest"])
    return model


__all__ = [
    "PRESETS", "Trained", "build_pipeline", "check_categories", "dealt", "fit", "fit_pipeline", "gbt", "labelled", "latest", "load",
    "model_digest", "model_feature_columns", "model_input", "probability_of_default", "save", "scored_rows",
]
