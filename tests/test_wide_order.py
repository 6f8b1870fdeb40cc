"""wide_clean_table writes its rows in the order of their prices: the same rows on less disk."""

import os

import pytest
from pyspark.sql import functions as F

from riskfold import queries as Q
from riskfold.operators import clean as clean_ops
from riskfold.sources import fixtures


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """12,000 rows, some of them twice and some with nulls; a third has one price, the others about four a price."""
    path = str(tmp_path_factory.mktemp("wide-order"))
    spark.range(12_000, numPartitions=3).withColumn("i", F.col("id") % 11_700).selectExpr(
        "i AS l_orderkey", "IF(i % 101 = 0, NULL, i * 7 % 900) AS l_partkey", "i * 13 % 70 AS l_suppkey", "CAST(i % 7 + 1 AS INT) AS l_linenumber",
        "IF(i % 89 = 0, NULL, CAST(i % 50 + 1 AS DOUBLE)) AS l_quantity",
        "IF(i % 97 = 0, NULL, IF(i % 3 = 0, 950.5D, 900 + (i * 7919) % 2003 * 1.25D)) AS l_extendedprice", "(i % 11) / 100D AS l_discount",
        "(i % 9) / 100D AS l_tax", "substring('ANR', CAST(i % 3 + 1 AS INT), 1) AS l_returnflag",
        "IF(i % 2 = 0, 'F', 'O') AS l_linestatus", "CAST(date_add(DATE '1999-01-01', CAST(i % 900 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_same_rows_on_less_disk(spark, data, tmp_path):
    df, roles = Q._wide(spark, data)
    sizes, found = [], []
    for name, rows in (("before", clean_ops.clean(df, roles).df), ("now", Q.q_wide_clean_table(spark, data))):
        rows.coalesce(2).write.parquet(f"{tmp_path}/{name}")
        again = spark.read.parquet(f"{tmp_path}/{name}")
        found.append((again.schema, sorted(map(tuple, again.groupBy(F.xxhash64(*again.columns).alias("h")).count().collect()))))
        sizes.append(sum(os.path.getsize(f"{tmp_path}/{name}/{f}") for f in os.listdir(f"{tmp_path}/{name}") if f.endswith(".parquet")))
    assert found[0] == found[1] and len(found[0][1]) > 10_000
    assert sizes[1] < 0.95 * sizes[0]


def test_one_price_of_many_rows_is_divided(spark, data):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = fixtures.wide_statements_by_price(spark, data)
        counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(counts) == 12_000 and max(counts) < 0.25 * 12_000
