"""Append-only runs table: one row per trained model (columns, metrics, config).

Layout under the table's folder:

* ``log/<entry>.json``: one appended record, a JSON line with its entry's name.
  Entries have names of their own, so writers never meet.  A line that is not
  whole yet is no record.
* ``snapshots/v.../``: all records up to a compaction as one Parquet file, with
  the names of their entries; it counts once it is complete.

A reader takes the newest snapshot and the entries that are not in it.  A
compaction writes a new snapshot of what a reader sees, and only removes
entries that an *older* complete snapshot holds already: a record that is
appended while it runs stays in the log, and a reader that has listed the
files before it still finds all of them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.session import delete_path, file_names, path_exists, publish, versions, write_text

# The field names of the original record, where it has the field.
RUN_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("preset", T.StringType()),
    T.StructField("params", T.StringType()),
    T.StructField("id_cols", T.ArrayType(T.StringType())),
    T.StructField("label_col", T.StringType()),
    T.StructField("categorical_cols", T.ArrayType(T.StringType())),
    T.StructField("numeric_cols", T.ArrayType(T.StringType())),
    T.StructField("feature_input_cols", T.ArrayType(T.StringType())),
    T.StructField("dropped_cols", T.ArrayType(T.StringType())),
    T.StructField("class_weights", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("auc", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("tp", T.LongType()),
    T.StructField("tn", T.LongType()),
    T.StructField("fp", T.LongType()),
    T.StructField("fn", T.LongType()),
    T.StructField("shuffle_partitions", T.IntegerType()),
    T.StructField("default_parallelism", T.IntegerType()),
    T.StructField("cores", T.StringType()),
    T.StructField("driver_memory", T.StringType()),
])


def run_record(spark: SparkSession, name: str, path: str, trained, metrics: dict,
               feature_input_cols) -> DataFrame:
    r = trained.roles
    row = (
        name, path, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), trained.preset,
        json.dumps(trained.params, sort_keys=True), list(r.id_cols), r.label_col,
        list(r.categorical), list(r.numeric), list(feature_input_cols), list(trained.dropped),
        {str(k): float(v) for k, v in trained.weights.items()},
        *(float(metrics[k]) if metrics.get(k) is not None else None
          for k in ("auc", "precision", "recall", "f1_score")),
        *(int(metrics[k]) for k in ("tp", "tn", "fp", "fn")),
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        int(spark.sparkContext.defaultParallelism),
        _cores(spark),
        spark.sparkContext.getConf().get("spark.driver.memory", None),
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def _cores(spark: SparkSession) -> str:
    """The cores that were asked for: of a local master, or of each executor."""
    conf, master = spark.sparkContext.getConf(), spark.sparkContext.master
    return master.partition("[")[2].rstrip("]") if master.startswith("local[") else conf.get("spark.executor.cores", "")


ENTRY = "__entry"
_STORED = T.StructType([*RUN_SCHEMA.fields, T.StructField(ENTRY, T.StringType())])


def append_run(record: DataFrame, runs_path: str) -> str:
    """Append the one row of ``record``; the name of its entry."""
    (line,) = record.toJSON().collect()  # one record
    return _append(record.sparkSession, json.loads(line), runs_path)


def _append(spark: SparkSession, record: dict, runs_path: str) -> str:
    now = dt.datetime.now(dt.timezone.utc)
    entry = f"e{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
    write_text(spark, f"{runs_path}/log/{entry}.json", json.dumps({**record, ENTRY: entry}) + "\n")
    return entry


def _log(spark: SparkSession, runs_path: str) -> DataFrame:
    if not file_names(spark, f"{runs_path}/log"):
        return spark.createDataFrame([], _STORED)
    rows = spark.read.schema(_STORED).option("mode", "PERMISSIVE").json(f"{runs_path}/log")
    return rows.where(F.col(ENTRY).isNotNull())  # the entry's name is written last


def _stored(spark: SparkSession, runs_path: str) -> DataFrame:
    """All records with their entries: the newest snapshot, and the log beyond it."""
    snapshots = versions(spark, f"{runs_path}/snapshots")
    log = _log(spark, runs_path)
    if not snapshots:
        return log
    held = spark.read.schema(_STORED).parquet(snapshots[-1])
    return held.unionByName(log.join(held.select(ENTRY), ENTRY, "left_anti"))


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """Every appended run once."""
    if not path_exists(spark, runs_path):
        raise FileNotFoundError(f"no runs table at {runs_path}")
    return _stored(spark, runs_path).drop(ENTRY)


def compact_runs(spark: SparkSession, runs_path: str) -> str:
    """Write all runs as one snapshot, and remove entries and snapshots that an older snapshot makes superfluous.

    The snapshot before the new one and the entries that came after it stay
    until the next compaction, for readers that are at work.
    """
    before = versions(spark, f"{runs_path}/snapshots")
    path = publish(spark, lambda p: _stored(spark, runs_path).coalesce(1).write.parquet(p), f"{runs_path}/snapshots")  # a row a model
    if before:
        inside = {r[ENTRY] for r in spark.read.schema(_STORED).parquet(before[-1]).select(ENTRY).collect()}  # a name a model
        for name in file_names(spark, f"{runs_path}/log"):
            if name.removesuffix(".json") in inside:
                delete_path(spark, f"{runs_path}/log/{name}")
        for old in before[:-1]:
            delete_path(spark, old)
    return path


def model_info(spark: SparkSession, runs_path: str) -> DataFrame:
    """Latest run per model name (``max_by`` aggregate, no sort of the table).

    ``version`` is the last part of the model's path.
    """
    runs = read_runs(spark, runs_path)
    latest = runs.groupBy("model_name").agg(
        F.max_by(F.struct(*[c for c in runs.columns if c != "model_name"]), F.struct("created_at", "model_path")).alias("r"),
        F.count(F.lit(1)).alias("n_versions"),
    )
    return latest.select(
        "model_name", "n_versions", F.element_at(F.split("r.model_path", "/"), -1).alias("version"),
        "r.created_at", "r.model_path", "r.preset",
        "r.auc", "r.precision", "r.recall", "r.f1_score", "r.tp", "r.tn", "r.fp", "r.fn",
        "r.categorical_cols", "r.numeric_cols",
        F.size("r.numeric_cols").alias("n_numeric"), F.size("r.categorical_cols").alias("n_categorical"),
        F.size("r.feature_input_cols").alias("n_features"),
    )


def latest_model_path(spark: SparkSession, runs_path: str, name: str) -> str | None:
    """Path of the newest run's model of that name."""
    r = model_info(spark, runs_path).where(F.col("model_name") == name).select("model_path").first()
    return r["model_path"] if r else None
