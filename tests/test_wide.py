"""The wide keys derive their cells while reading: the same rows, and no table is written on the way."""

import pytest
from pyspark.sql import functions as F

from riskfold import queries as Q
from riskfold.operators import clean as clean_ops, profile
from riskfold.session import shared_root, versions
from riskfold.sources import fixtures
from tests.test_plans import nodes, plan, read_schemas

WIDE = ("wide_null_nan_percent", "wide_missing_rate", "wide_clean_table", "wide_column_means", "wide_string_index")


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """A lineitem of 2,000 rows, some of them twice and some with nulls."""
    path = str(tmp_path_factory.mktemp("wide"))
    rows = spark.range(2000, numPartitions=3).withColumn("i", F.col("id") % 1700).selectExpr(
        "i AS l_orderkey", "IF(i % 101 = 0, NULL, i * 7 % 900) AS l_partkey", "i * 13 % 70 AS l_suppkey", "CAST(i % 7 + 1 AS INT) AS l_linenumber",
        "IF(i % 89 = 0, NULL, CAST(i % 50 + 1 AS DOUBLE)) AS l_quantity", "i * 1.25D AS l_extendedprice", "(i % 11) / 100D AS l_discount",
        "(i % 9) / 100D AS l_tax", "substring('ANR', CAST(i % 3 + 1 AS INT), 1) AS l_returnflag",
        "IF(i % 2 = 0, 'F', 'O') AS l_linestatus", "CAST(date_add(DATE '1999-01-01', CAST(i AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate")
    rows.write.parquet(f"{path}/lineitem.parquet")
    return path


def test_wide_keys_write_no_table(spark, data):
    base = f"{shared_root(spark)}/riskfold/tables"
    for name in WIDE:
        df = Q.QUERIES[name](spark, data)
        text = plan(spark, df)
        assert df.count() > 0
        assert all("l_partkey" in s and "n_000" not in s for s in read_schemas(text)), name
        assert not versions(spark, f"{base}/wide-fresh")


def test_wide_keys_give_the_rows_of_the_written_table(spark, data):
    table, view = fixtures.wide_statements(spark, data), Q._wide(spark, data)[0]
    roles = fixtures.wide_roles(table)
    assert roles == fixtures.wide_roles(view)
    for work in (lambda d: profile.null_nan_percent(d, roles), lambda d: clean_ops.clean(d, roles).df):
        a, b = work(table), work(view)
        assert a.schema == b.schema and a.count() == b.count() > 0
        same = lambda d: d.groupBy(F.xxhash64(*d.columns).alias("h")).count()
        assert sorted(same(a).collect()) == sorted(same(b).collect())
    assert "Exchange" not in nodes(plan(spark, clean_ops.clean(view, roles).df))
