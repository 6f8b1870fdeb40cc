"""Feature preparation as Spark ML pipeline stages.

Stage order: cast (numeric -> double, categorical -> string with NULL ->
'missing'), mean imputation of NULL *and* NaN, multi-column string indexing
by descending frequency (ties alphabetical, unseen -> last index), assembly
of numeric then indexed columns, standardisation to mean 0 / unit sample
standard deviation.  Every stage lives in the saved PipelineModel, so
training and serving apply the same imputation and encoding.

Each fit is one aggregate pass (Imputer: one avg per column; StringIndexer:
one count per (column, value); StandardScaler: one summariser pass); no stage
fit shuffles rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.functions.missing import lit_str, present_sql
from riskfold.roles import Roles

# Fixed value: the category assigned to a NULL categorical.
MISSING_CATEGORY = "missing"

NUM, CAT, IMP, IDX = "__num", "__cat", "_imp", "_idx"
# The names of the assembled and the scaled vector.
UNSCALED, FEATURES = "features_unnorm", "features"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cast_stage(roles: Roles) -> SQLTransformer:
    """Numeric features to double, categoricals to string with NULL -> 'missing'.

    Casting categoricals to string first means an integer code and its text
    index the same way at training and serving time.  A numeric feature that
    is a double already stays as it is: an alias of every feature would make
    Catalyst's constraints on a wide table double with each.
    """
    parts = ["*"]
    parts += [f"CAST({_q(c)} AS DOUBLE) AS {_q(c + NUM)}" for c in roles.numeric if numeric_input(roles, c) != c]
    parts += [
        f"COALESCE(CAST({_q(c)} AS STRING), '{MISSING_CATEGORY}') AS {_q(c + CAT)}"
        for c in roles.categorical
    ]
    return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def numeric_input(roles: Roles, column: str) -> str:
    """The column the imputer reads for a numeric feature: itself if a double, else its cast."""
    return column if roles.type_of(column) == "double" else column + NUM


def imputer_stage(roles: Roles) -> Imputer:
    return Imputer(
        strategy="mean",
        inputCols=[numeric_input(roles, c) for c in roles.numeric],
        outputCols=[c + IMP for c in roles.numeric],
    )


def indexer_stage(roles: Roles) -> StringIndexer:
    return StringIndexer(
        inputCols=[c + CAT for c in roles.categorical],
        outputCols=[c + IDX for c in roles.categorical],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def feature_input_cols(roles: Roles, categorical: bool = True) -> list[str]:
    cols = [c + IMP for c in roles.numeric]
    if categorical:
        cols += [c + IDX for c in roles.categorical]
    return cols


def assembler_stage(roles: Roles, categorical: bool = True) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_input_cols(roles, categorical), outputCol=UNSCALED)


def scaler_stage() -> StandardScaler:
    return StandardScaler(inputCol=UNSCALED, outputCol=FEATURES, withMean=True, withStd=True)


def preparation_stages(roles: Roles) -> list:
    stages = [cast_stage(roles)]
    if roles.numeric:
        stages.append(imputer_stage(roles))
    if roles.categorical:
        stages.append(indexer_stage(roles))
    stages += [assembler_stage(roles), scaler_stage()]
    return stages


# --- standalone operators (each is one stage fitted and applied on ``df``) ---

def column_means(df: DataFrame, roles: Roles) -> DataFrame:
    """Long ``(column_name, mean, n_present)``; NaN counts as missing, as in the imputer."""
    aggs = []
    for i, c in enumerate(roles.numeric):
        v = f"CAST({present_sql(c, c in roles.floating)} AS DOUBLE)"
        aggs += [f"avg({v}) AS m{i}", f"count({v}) AS n{i}"]
    wide = df.selectExpr(*aggs)
    rows = ", ".join(
        f"named_struct('column_name', {lit_str(c)}, 'mean', m{i}, 'n_present', n{i})"
        for i, c in enumerate(roles.numeric)
    )
    return wide.selectExpr(f"inline(array({rows}))")


def fill_categorical(df: DataFrame, roles: Roles, keep=None) -> DataFrame:
    keep = list(roles.id_cols) if keep is None else list(keep)
    return df.selectExpr(
        *[_q(c) for c in keep],
        *[f"coalesce(CAST({_q(c)} AS STRING), '{MISSING_CATEGORY}') AS {_q(c)}" for c in roles.categorical],
    )


def impute_mean(df: DataFrame, roles: Roles, keep=None, means: dict | None = None) -> DataFrame:
    """Numeric features with NULL and NaN replaced by the column mean.

    ``means`` (of the present values) spare a pass where they are known.
    """
    keep = list(roles.id_cols) if keep is None else list(keep)
    if means is None:
        means = {r["column_name"]: r["mean"] for r in column_means(df, roles).collect()} if roles.numeric else {}
    return df.selectExpr(
        *[_q(c) for c in keep],
        *[f"coalesce(CAST({present_sql(c, c in roles.floating)} AS DOUBLE), CAST({means[c]!r} AS DOUBLE)) AS {_q(c)}"
          if means[c] is not None else f"CAST({present_sql(c, c in roles.floating)} AS DOUBLE) AS {_q(c)}"
          for c in roles.numeric],
    )


def string_index(df: DataFrame, roles: Roles, keep=None, fit_on: DataFrame | None = None) -> DataFrame:
    """Filled categorical plus its frequency-ordered index ``<col>_idx``."""
    keep = list(roles.id_cols) if keep is None else list(keep)
    model = Pipeline(stages=[cast_stage(roles), indexer_stage(roles)]).fit(fit_on or df)
    out = model.transform(df)
    cols = []
    for c in roles.categorical:
        cols += [F.col(c + CAT).alias(c), F.col(c + IDX).alias(c + IDX)]
    return out.select(*keep, *cols)


def standard_scale(df: DataFrame, roles: Roles, keep=None, stats: dict | None = None) -> DataFrame:
    """Mean-imputed numeric features standardised; one ``<col>_z`` per feature.

    Same numbers as the pipeline's stages (see :func:`prepared_columns`) on
    numeric features, in one aggregate pass plus one projection: imputing with
    the mean keeps the mean, and the imputed sample variance is
    ``var_present * (n_present - 1) / (n - 1)``.  A constant column scales to
    0.  ``stats`` (:func:`riskfold.operators.clean.feature_stats` with
    moments) spare the pass.
    """
    from riskfold.operators.clean import feature_stats

    keep = list(roles.id_cols) if keep is None else list(keep)
    stats = feature_stats(df, roles, moments=True) if stats is None else stats
    n, cols = stats["n_rows"], []
    for c in roles.numeric:
        mean, var, k = stats[f"__mean__{c}"], stats[f"__var__{c}"], stats[c]
        if mean is None:
            raise ValueError(f"column {c} has no present value to impute from")
        std = (var * (k - 1) / (n - 1)) ** 0.5 if (var is not None and n > 1) else 0.0
        x = f"coalesce(CAST({present_sql(c, c in roles.floating)} AS DOUBLE), CAST({mean!r} AS DOUBLE))"
        z = f"({x} - CAST({mean!r} AS DOUBLE)) / CAST({std!r} AS DOUBLE)" if std > 0 else "CAST(0.0 AS DOUBLE)"
        cols.append(f"{z} AS {_q(c + '_z')}")
    return df.selectExpr(*[_q(c) for c in keep], *cols)


def prepared_columns(df: DataFrame, roles: Roles, keep, fit_on: DataFrame) -> DataFrame:
    """The stages that ship, fitted on ``fit_on``: the scaled vector as one column a feature.

    ``<col>_z`` for numeric features, ``<col>_idx_z`` for indexed ones.
    """
    out = Pipeline(stages=preparation_stages(roles)).fit(fit_on).transform(df)
    arr = vector_to_array(F.col(FEATURES))
    names = [c + "_z" for c in roles.numeric] + [c + IDX + "_z" for c in roles.categorical]
    return out.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])
