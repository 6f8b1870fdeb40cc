"""fit_layouts deals a larger table to more partitions, so no task reads more of it."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from riskfold import queries as Q


def test_partitions_grow_with_the_rows(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr(
        "id AS l_orderkey", "id % 90 AS l_partkey", "id % 20 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount", "0.01D AS l_tax",
        "'A' AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP_NTZ '2001-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = []

    def fit(df, roles, num_partitions, **_):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((len(sizes), max(sizes), num_partitions))
        return SimpleNamespace(model=None)

    monkeypatch.setattr(Q.train_plan, "fit", fit)
    monkeypatch.setattr(Q.train_plan, "model_digest", lambda model: "same")
    for most, times in ((4_000_000, 1), (1000, 3)):
        seen.clear()
        monkeypatch.setattr(Q, "LAYOUT_ROWS", most)
        rows = Q.q_fit_layouts(spark, str(tmp_path)).collect()
        assert [tuple(r) for r in rows] == [(1, True), (4, True), (8, True)]
        assert [(n, k) for n, _, k in seen] == [(n * times, 8 * times) for n in (1, 4, 8)]
        assert seen[0][1] <= min(3000, most) + 3
