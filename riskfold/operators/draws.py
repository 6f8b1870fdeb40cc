"""Boosting that draws rows anew in each round, on equal rows counted together.

A round of stochastic gradient boosting keeps each training row by chance.
Rows that agree in label, weight and the bins of all features are the same to
the trees, so what counts is how many of them are kept: of ``n`` rows each kept
with probability ``p`` that is a binomial number, drawn for each cell of equal
rows and round.  The law is that of drawing the rows one by one; a round goes
over the cells, of which there are at most as many as the grid of bins has.

The bins come from counts of the raw values of all rows, so neither they nor
the cells nor the draws depend on the layout of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.functions.missing import present_sql
from riskfold.operators.pool import PROBES, TOGETHER, centres
from riskfold.operators.prep import FEATURES
from riskfold.roles import Roles
from riskfold.session import shared_root

#: Rows from which on they are counted together; fewer are drawn one by one, which is as quick.
LEAST_ROWS = 1_000_000
#: Cells of a histogram: so many rows a pass reach the driver, about.
CELLS = 1 << 14
#: Passes of a histogram at most: each divides what holds too many rows by 64 and more.
PASSES = 8
#: Rounds drawn at once where there is no checkpoint in between.
AHEAD = 10
COUNT = "__n"


def histogram(df: DataFrame, value: str, low: float, high: float, n: int, share: int) -> list[tuple[float, float, int]]:
    """``(least, largest, rows)`` of disjoint ranges of the values in ascending order; exact, whatever the layout.

    A range of more than one value holds at most a ``share``-th of the ``n``
    rows: one that holds more is divided again by another pass.  What still
    does after ``PASSES`` differs by no more than 2^-48 of the values' span.
    """
    done, todo = [], [(low, high, n)]
    for _ in range(PASSES):
        cells = max(64, CELLS // len(todo))
        v, arms = F.col(value), None
        for i, (lo, hi, _) in enumerate(todo):
            scale = cells / (hi - lo) if hi > lo else 0.0
            if not math.isfinite(scale):  # neighbouring doubles
                scale = 0.0
            cell = F.lit(i * (cells + 1)) + F.floor((v - lo) * scale).cast("long")
            hit = v.between(lo, hi)
            arms = F.when(hit, cell) if arms is None else arms.when(hit, cell)
        found = df.select(v.alias("v"), arms.alias("cell")).where("cell IS NOT NULL").groupBy("cell").agg(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
        ranges = [(r["lo"], r["hi"], r["n"]) for r in found]
        todo = sorted(r for r in ranges if r[1] > r[0] and r[2] * share > n)
        done += [r for r in ranges if not (r[1] > r[0] and r[2] * share > n)]
        if not todo:
            break
    return sorted(done + todo)


def _centres(ranges: list[tuple[float, float, int]], bins: int) -> list[float]:
    """At most ``bins`` values: all there are, or those nearest to the quantiles of all rows."""
    if len(ranges) <= bins and all(lo == hi for lo, hi, _ in ranges):
        return [lo for lo, _, _ in ranges]
    total, probes = np.cumsum([n for _, _, n in ranges]), PROBES * bins
    at = np.searchsorted(total, (np.arange(probes) + 0.5) / probes * total[-1])
    return centres([ranges[i][0] for i in at], bins)


@dataclass
class Cells:
    """Equal rows counted together: label, weight, ``COUNT`` and the raw features, a value of its bin for each number."""

    df: DataFrame
    keys: list[str]


def counted(df: DataFrame, n: int, roles: Roles, weight_col: str, means: dict, n_labels: list[int], bins: int) -> Cells | None:
    """The ``n`` rows of ``df`` as cells of equal rows, or None where the grid of bins is no smaller than the table.

    ``means`` has the value that a missing one of each number gets, ``n_labels``
    the number of values of each categorical.
    """
    grid, chosen, values = 2 * math.prod(n_labels), {}, {}
    for lo in range(0, len(roles.numeric), TOGETHER):
        block = roles.numeric[lo:lo + TOGETHER]
        for c in block:
            values[c] = F.expr(f"CAST({present_sql(c, c in roles.floating)} AS DOUBLE)")
        ends = df.agg(*[f(values[c]).alias(f"{k}{i}") for i, c in enumerate(block) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
        for i, c in enumerate(block):
            if grid >= n:
                return None
            here, least, most = (ends[f"{k}{i}"] for k in ("n", "lo", "hi"))
            ranges = []
            if here:
                if not math.isfinite(most - least):
                    return None  # no span that could be divided
                ranges = histogram(df.select(values[c].alias("v")), "v", least, most, here, PROBES * bins)
            if here < n:
                ranges = sorted([*ranges, (means[c], means[c], n - here)])
            chosen[c] = _centres(_merged(ranges), bins)
            grid *= len(chosen[c])
    if grid >= n:
        return None
    return _cells(df, roles, weight_col, means, values, chosen)


def _merged(ranges):
    """The ranges with equal single values as one: the mean may be a value of the column."""
    out = []
    for lo, hi, n in ranges:
        if out and out[-1][0] == out[-1][1] == lo == hi:
            out[-1] = (lo, hi, out[-1][2] + n)
        else:
            out.append((lo, hi, n))
    return out


def _cells(df: DataFrame, roles: Roles, weight_col: str, means: dict, values: dict, chosen: dict) -> Cells:
    binned = {c: v for c, v in chosen.items() if len(v) > 1}
    x = df.select(roles.label_col, weight_col, *[F.col(f"`{c}`") for c in roles.categorical],
                  *[F.coalesce(values[c], F.lit(means[c])).alias(f"__x{i}") for i, c in enumerate(binned)])
    if binned:
        splits = []
        for v in map(np.array, binned.values()):
            # a tree sends a value at the split to the left
            splits.append([-math.inf, *np.nextafter((v[:-1] + v[1:]) / 2.0, np.inf).tolist(), math.inf])
        x = Bucketizer(splitsArray=splits, inputCols=[f"__x{i}" for i in range(len(binned))],
                       outputCols=[f"__b{i}" for i in range(len(binned))]).transform(x)
    keys = [roles.label_col, weight_col, *roles.categorical, *[f"__b{i}" for i in range(len(binned))]]
    order = [F.col(f"`{k}`") for k in keys]
    cells = x.groupBy(*order).agg(F.count(F.lit(1)).alias(COUNT))
    number = {c: F.element_at(F.array(*map(F.lit, v)), F.col(f"__b{i}").cast("int") + 1) for i, (c, v) in enumerate(binned.items())}
    number |= {c: F.lit(v[0]) for c, v in chosen.items() if len(v) == 1}
    return Cells(cells.select(*order, COUNT, *[number[c].cast("double").alias(c) for c in roles.numeric]), keys)


def dealt_cells(cells: Cells, num_partitions: int) -> DataFrame:
    """The cells in a layout that depends on their bins alone."""
    order = [F.col(f"`{k}`") for k in cells.keys]
    return cells.df.repartition(num_partitions, *order).sortWithinPartitions(*order)


def kept(n: str, rate: float, seed: int, rounds: int) -> F.Column:
    """How many of ``n`` rows each of ``rounds`` rounds keeps, a row with probability ``rate``; drawn by partition and place."""

    def draw(counts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rng = np.random.default_rng([seed % (1 << 64), TaskContext.get().partitionId()])
        for c in counts:
            k = rng.binomial(c.to_numpy(zero_copy_only=False)[:, None], rate, (len(c), rounds))
            yield pa.ListArray.from_arrays(np.arange(0, k.size + 1, rounds, dtype="int32"), k.ravel())

    draw.__annotations__ = {"counts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(draw, "array<long>").asNondeterministic()(n)


def can_draw(trees: GBTClassifier) -> bool:
    """Whether :func:`boosted` knows all that the classifier is set to."""
    return (trees.getSubsamplingRate() < 1 and trees.getMinInstancesPerNode() <= 1 and trees.getFeatureSubsetStrategy() == "all"
            and trees.getLossType() == "logistic" and not trees.isDefined(trees.validationIndicatorCol))


def boosted(cells: DataFrame, trees: GBTClassifier) -> GBTClassificationModel:
    """``trees`` fitted on cells with :data:`COUNT` equal rows each, of which every round keeps its share by chance.

    Spark's rounds: the first tree is fitted on the labels -1 and 1, each other
    one on what the logistic loss of the trees before leaves.  The margins are
    written to the checkpoint folder every ``checkpointInterval`` rounds.
    """
    label, weight, every = trees.getLabelCol(), trees.getWeightCol(), trees.getCheckpointInterval()
    rate, step, seed = trees.getSubsamplingRate(), trees.getStepSize(), trees.getSeed()
    one = DecisionTreeRegressor(
        featuresCol=FEATURES, labelCol="__residual", weightCol="__weight", predictionCol="__tree", maxDepth=trees.getMaxDepth(),
        maxBins=trees.getMaxBins(), minInstancesPerNode=trees.getMinInstancesPerNode(), minInfoGain=trees.getMinInfoGain(),
        minWeightFractionPerNode=trees.getMinWeightFractionPerNode(), maxMemoryInMB=trees.getMaxMemoryInMB(),
        cacheNodeIds=trees.getCacheNodeIds(), checkpointInterval=every, impurity="variance", seed=seed)
    y, margin, ahead = F.col("__y"), F.col("__margin"), every if every > 0 else AHEAD
    rows = cells.select(FEATURES, (F.col(label) * 2 - 1).alias("__y"), F.col(weight).alias("__w"), COUNT, F.lit(0.0).alias("__margin")).persist(
        StorageLevel.MEMORY_AND_DISK)
    # Weights are brought to the finest unit of which all rows' sum is exact in a double: Spark takes what a feature's
    # values lack of that sum for rows of value 0, and a last bit would give a feature a split at a value it has not.
    unit = 2.0 ** (51 - math.frexp(rows.agg(F.sum(F.col("__w") * F.col(COUNT))).first()[0] or 1.0)[1])
    state = rows.withColumn("__w", F.floor(F.col("__w") * unit + 0.5) / unit)
    models, before = [], rows
    try:
        for m in range(trees.getMaxIter()):
            if m % ahead == 0:
                state = state.withColumn("__kept", kept(COUNT, rate, seed + m, ahead))
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            residual = y if m == 0 else 4.0 * y / (1.0 + F.exp(2.0 * y * margin))
            k = F.col("__kept")[m % ahead]
            models.append(one.fit(state.where(k > 0).select(
                FEATURES, residual.alias("__residual"), (F.col("__w") * k).alias("__weight"))))
            before.unpersist()
            before, state = state, models[-1].transform(state).select(
                FEATURES, "__y", "__w", COUNT, (margin + (1.0 if m == 0 else step) * F.col("__tree")).alias("__margin"), "__kept")
            if every > 0 and (m + 1) % every == 0 and m + 1 < trees.getMaxIter():
                shared_root(cells.sparkSession)
                state = state.checkpoint()
    finally:
        before.unpersist()
        state.unpersist()
    return _model(trees, models, [1.0, *[step] * (len(models) - 1)])


def _model(trees: GBTClassifier, models: list, weights: list[float]) -> GBTClassificationModel:
    from pyspark.sql import SparkSession

    sc = SparkSession.getActiveSession().sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    of = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(models))
    by = gateway.new_array(jvm.double, len(models))
    for i, (model, w) in enumerate(zip(models, weights)):
        of[i], by[i] = model._java_obj, w
    java = trees._to_java()
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), of, by, models[0].numFeatures, 2)
    java.copyValues(made.setParent(java), jvm.org.apache.spark.ml.param.ParamMap())
    return trees._copyValues(GBTClassificationModel(made))

