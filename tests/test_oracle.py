"""Every exactly-checkable query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tools.oracle_check import compare

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck001, name):
    r = compare(spark, duck001, name, QUERIES[name], ORACLE[name], SF001)
    assert r["ok"], r.get("why")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert set(df.columns) >= {"auc", "tp", "tn", "fp", "fn", "precision", "recall"}
