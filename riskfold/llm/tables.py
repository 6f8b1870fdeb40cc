"""Tables kept in the shared folder, and totals over a global sort order.

Lineage is cut by writing Parquet into the folder that ``spark.checkpoint.dir``
names, so an executor may be lost at any time and nothing is computed twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfold.session import delete_path, shared_path

PART = "__part"
ROW = "__row"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; the owner of that folder clears it."""
    return shared_path(spark, "riskfold-llm", f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the folder of a table of :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    folder = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for path in folder:
        if "/riskfold-llm/" not in path:
            raise ValueError(f"{path} is no intermediate table")
        delete_path(spark, path)


def with_row_ids(df: DataFrame, label: str, name: str = ROW) -> DataFrame:
    """``df`` with a unique ``name`` that stays the same in every later read.

    Rows may repeat in every column, so later joins need a key of their own.
    """
    return written(df.withColumn(name, F.monotonically_increasing_id()), label)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def totals_before(
    df: DataFrame, order: list[Column], sums: dict[str, Column], label: str, wide: bool = False,
) -> DataFrame:
    """Add, for each ``name: value`` of ``sums``, the sum of all rows before in ``order``.

    The rows are dealt out by range and written, so no window spans more than
    one range; the ranges' own totals are one row a range.  Rows that tie in
    ``order`` come in an arbitrary but consistent order, so ties must be
    exchangeable.
    """
    n = shuffle_width(df.sparkSession)
    named = df.select("*", *[v.alias(f"__v_{k}") for k, v in sums.items()])
    ranged = written(
        named.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()), label
    )
    each = ranged.groupBy(PART).agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = each.select(
        PART, *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in sums]
    )
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(offsets), PART)  # at most one row a shuffle partition
    return out.select(
        *[c for c in df.columns],
        *[
            (F.col(f"__o_{k}") + F.coalesce(F.sum(f"__v_{k}").over(within), F.lit(0))).alias(k)
            for k in sums
        ],
    )
