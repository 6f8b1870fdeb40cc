"""Equal training rows as one weighted row, for trees that look at bins.

A tree never tells values of one bin apart, and its statistics are weighted
sums.  So features are brought to at most ``bins`` values each, and rows that
then agree in all features, label and weight become one row with the sum of
their weights.  Boosting goes over the data some hundred times; pooled, it goes
over at most as many rows as the grid of bins has cells, whatever the table's
size.  All rows count.

A feature of at most ``bins`` values keeps them.  One of more is brought to
the nearest of ``bins`` values at its quantiles over all rows, frequent values
first.  Trees split halfway between neighbouring values, which is where the
nearest value changes: a row falls on the same side at training and at scoring.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features that are counted in one pass: wide tables are known not to pool after the first one.
TOGETHER = 16
#: Quantiles that are asked for, for each bin.
PROBES = 8


def centres(probes: list[float], bins: int) -> list[float]:
    """At most ``bins`` values out of equally spaced quantiles: those that fill a bin, and the rest spread over the others."""
    counts = [(v, len(list(same))) for v, same in groupby(sorted(probes))]
    if len(counts) <= bins:
        return [v for v, _ in counts]
    frequent = {v for v, n in counts if n * bins >= len(probes)}
    rest = [v for v, n in counts if v not in frequent for _ in range(n)]
    left = bins - len(frequent)
    return sorted(frequent | {rest[int((i + 0.5) * len(rest) / left)] for i in range(left)})


def _grid(x: DataFrame, n_features: int, bins: int) -> list[int] | None:
    """Different values of each feature, about; None if the bins' grid has as many cells as the table has rows."""
    counts, cells = [], math.log(2)  # of two labels
    for lo in range(0, n_features, TOGETHER):
        block = range(lo, min(lo + TOGETHER, n_features))
        n, *found = x.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.col("x")[i]) for i in block]).first()
        counts += found
        cells += sum(math.log(max(1, min(k, bins))) for k in found)
        if not n or cells >= math.log(n):
            return None
    return counts


def pooled(df: DataFrame, features_col: str, label_col: str, weight_col: str, n_features: int, bins: int) -> DataFrame | None:
    """``features, label, weight`` with equal rows as one, or None where the grid of bins is no smaller than the table.

    Three passes and one shuffle with partial sums, of a row a cell and task.
    """
    x = df.select(F.col(label_col), F.col(weight_col), vector_to_array(features_col).alias("x"))
    counts = _grid(x, n_features, bins)
    if counts is None:
        return None
    probes = F.array(*[F.lit((i + 0.5) / (PROBES * bins)) for i in range(PROBES * bins)])
    few = [k <= 2 * bins for k in counts]  # so sets stay small; counts this small are off by a few at most
    found = x.agg(*[
        F.struct(F.collect_set(F.col("x")[i]).alias("all") if few[i] else F.lit(None).cast("array<double>").alias("all"),
                 F.percentile_approx(F.col("x")[i], probes, 10_000).alias("probes")).alias(f"f{i}")
        for i in range(n_features)]).first()
    splits = {}
    for i, f in enumerate(found):
        if few[i] and len(f["all"]) <= bins:
            continue  # keeps its values
        c = np.array(centres(f["probes"], bins))
        splits[i] = (c, np.nextafter((c[:-1] + c[1:]) / 2.0, np.inf))  # a tree sends a value at the split to the left
    cells = x.select(label_col, weight_col, *[F.col("x")[i].alias(f"x{i}") for i in range(n_features)])
    binned = {i: s for i, s in splits.items() if len(s[0]) > 1}
    if binned:
        cells = Bucketizer(
            splitsArray=[[-math.inf, *s.tolist(), math.inf] for _, s in binned.values()],
            inputCols=[f"x{i}" for i in binned], outputCols=[f"b{i}" for i in binned]).transform(cells)

    def value(i):
        if i in binned:
            return F.element_at(F.array(*map(F.lit, binned[i][0].tolist())), F.col(f"b{i}").cast("int") + 1)
        return F.lit(float(splits[i][0][0])) if i in splits else F.col(f"x{i}")

    names = [f"v{i}" for i in range(n_features)]
    cells = cells.select(label_col, weight_col, *[value(i).alias(v) for i, v in enumerate(names)])
    rows = cells.groupBy(label_col, weight_col, *names).agg(F.count(F.lit(1)).alias("__n"))
    return rows.select(
        label_col, (F.col(weight_col) * F.col("__n")).alias(weight_col), array_to_vector(F.array(*names)).alias(features_col))
