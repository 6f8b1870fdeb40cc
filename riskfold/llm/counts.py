"""Sums of large count arrays over all tasks, as a tree of small groups."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.llm.tables import written

#: Arrays that one task adds up at a time.
FAN_IN = 16


def summed(
    df: DataFrame, size: int, add: Callable[[], Callable[[pa.RecordBatch, np.ndarray], None]], label: str,
) -> np.ndarray:
    """The sum over all batches of what ``add()(batch, totals)`` adds to ``totals`` (of ``size`` integers).

    Each task keeps one array and sends it deflated; groups of ``FAN_IN``
    arrays are added up until one is left.  So a task holds two arrays and the
    driver gets one, whatever the number of tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, more = np.zeros(size, dtype=np.int64), add()
        for batch in batches:
            more(batch, totals)
        if totals.any():
            yield _row(TaskContext.get().partitionId(), totals)

    parts = written(df.mapInArrow(count, "part long, counts binary"), label)
    n = parts.agg(F.max("part")).first()[0]
    if n is None:
        return np.zeros(size, dtype=np.int64)
    while n > 0:
        parts = written(
            parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).repartition("part").sortWithinPartitions("part")
            .mapInArrow(_add_up(size), "part long, counts binary"), label)
        n //= FAN_IN
    return np.frombuffer(zlib.decompress(parts.first()["counts"]), dtype="<i8").copy()


def _row(part: int, totals: np.ndarray) -> pa.RecordBatch:
    packed = zlib.compress(totals.astype("<i8").tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed], pa.binary())], names=["part", "counts"])


def _add_up(size: int):
    def run(batches):
        at, totals = None, np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != at:
                    if at is not None:
                        yield _row(at, totals)
                    at, totals = part, np.zeros(size, dtype=np.int64)
                totals += np.frombuffer(zlib.decompress(counts.as_py()), dtype="<i8")
        if at is not None:
            yield _row(at, totals)

    return run
