"""String indexing with the dictionary as a table, for columns of any number of values.

``StringIndexer`` brings every value of every column to one reducer and to the
driver.  Here values are counted by a shuffle and ranked over ranges of
(column, count, value): each range is numbered by itself and gets its column's
rows of earlier ranges as an offset, so no task sees a whole column.  The
dictionary is applied by joins: the most frequent values of a column, among
which are all that hold a large share of the rows, by a broadcast of a fixed
number of rows, the others by a shuffle on a key of which no value has many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfold.functions.missing import q
from riskfold.operators.prep import IDX, MISSING_CATEGORY
from riskfold.roles import Roles
from riskfold.session import fresh_table

#: Values of a column that are broadcast; every other one has less than 1 in so many of the rows.
FREQUENT = 1000
#: Rows with a frequent value, which need no second join, are spread over so many keys of it.
SPREAD = 4096


def _text(column: str) -> str:
    return f"coalesce(CAST({q(column)} AS STRING), '{MISSING_CATEGORY}')"


def value_counts(df: DataFrame, columns) -> DataFrame:
    """``column_name, value, n`` of every value; NULL is the missing category."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    pairs = ", ".join("named_struct('column_name', '" + c.replace("\\", "\\\\").replace("'", "\\'") + f"', 'value', {_text(c)})" for c in columns)
    return df.selectExpr(f"inline(array({pairs}))").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def value_dictionary(df: DataFrame, columns) -> DataFrame:
    """``column_name, value, n, idx``: values numbered from 0 by falling count, then by value, within each column.

    The table is written to the shared folder, so every join reads the same
    numbers and the counting runs once.
    """
    spark = df.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("column_name"), F.col("n").desc(), F.col("value")]
    ranged = fresh_table(
        value_counts(df, columns).repartitionByRange(width, *order).withColumn("__part", F.spark_partition_id()), "value-counts")
    # (ranges + columns) rows at most: a column is in consecutive ranges
    each = ranged.groupBy("__part", "column_name").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("column_name").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select("__part", "column_name", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part", "column_name").orderBy(F.col("n").desc(), F.col("value"))
    ranked = ranged.join(F.broadcast(offsets), ["__part", "column_name"]).select(
        "column_name", "value", "n", (F.col("__before") + F.row_number().over(within) - 1).alias("idx"))
    return fresh_table(ranked, "value-dictionary")


def index_with(df: DataFrame, dictionary: DataFrame, columns, frequent: int = FREQUENT, id_prefix: str = "__ix") -> DataFrame:
    """``df`` with, for each of ``columns``, its text ``<c>__value`` and its number ``<c>_idx`` (double).

    A value that the dictionary lacks gets the number after the last, as an
    indexer that keeps unseen values does.
    """
    sizes = {r["column_name"]: r["n"] for r in dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i, c in enumerate(columns):
        mine = dictionary.where(F.col("column_name") == c)
        value, number, spread = f"{id_prefix}_v{i}", f"{id_prefix}_n{i}", f"{id_prefix}_s{i}"
        df = df.withColumn(value, F.expr(_text(c)))
        top = mine.where(F.col("idx") < frequent).select(F.col("value").alias(value), F.col("idx").alias(number))
        df = df.join(F.broadcast(top), value, "left")  # `frequent` rows at most
        if sizes.get(c, 0) > frequent:
            rest = mine.where(F.col("idx") >= frequent).select(
                F.concat(F.lit("v"), "value").alias(spread), F.col("idx").alias(f"{number}_rest"))
            # rows that have their number match nothing, and lie apart from each other
            apart = F.concat(F.lit("f"), (F.monotonically_increasing_id() % SPREAD).cast("string"))
            df = df.withColumn(spread, F.when(F.col(number).isNull(), F.concat(F.lit("v"), value)).otherwise(apart))
            df = df.join(rest, spread, "left").withColumn(number, F.coalesce(number, f"{number}_rest")).drop(spread, f"{number}_rest")
        df = df.withColumn(f"{c}{IDX}", F.coalesce(F.col(number), F.lit(sizes.get(c, 0))).cast("double")).drop(number)
        df = df.withColumnRenamed(value, f"{c}__value")
    return df


def string_index(df: DataFrame, roles: Roles, keep=None, fit_on: DataFrame | None = None, frequent: int = FREQUENT) -> DataFrame:
    """The rows of :func:`riskfold.operators.prep.string_index`, with the dictionary as a table."""
    keep = list(roles.id_cols) if keep is None else list(keep)
    dictionary = value_dictionary(fit_on if fit_on is not None else df, roles.categorical)
    out = index_with(df.select(*[F.col(q(c)) for c in dict.fromkeys([*keep, *roles.categorical])]), dictionary, roles.categorical, frequent)
    columns = [x for c in roles.categorical for x in (F.col(q(f"{c}__value")).alias(c), F.col(q(f"{c}{IDX}")))]
    return out.select(*[F.col(q(c)) for c in keep if c not in roles.categorical], *columns)
