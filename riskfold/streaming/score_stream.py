"""Score a stream of JSON request files with a saved pipeline.

The same stateless plan as bulk scoring, on ``readStream``.  One query scans
and parses the source once and writes each micro-batch's scored and rejected
rows into folders of its own attempt.  A batch counts once its manifest, which
names that attempt, is written, after both; readers
(:func:`read_committed`) see committed attempts only.  So a failure between
the two writes shows neither half, a batch that is repeated before its
manifest gets a new attempt, and one that is repeated after it is left as it
is: every row is seen exactly once, and nothing visible is ever replaced.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskfold.plans.score import score_requests
from riskfold.session import path_exists, write_text
from riskfold.sources.requests import parse_requests

BATCH, ATTEMPT = "batch_id", "attempt"
COMMITS = "commits"
PARTS = ("scored", "rejected")
_COMMIT_SCHEMA = f"{BATCH} long, {ATTEMPT} string"


def _manifest(sink_dir: str, batch_id: int) -> str:
    return f"{sink_dir}/{COMMITS}/{batch_id:020d}.json"


def write_batch(frames: dict[str, DataFrame], sink_dir: str, batch_id: int) -> None:
    """Write ``frames`` by name into a new attempt of the batch, then its manifest; a committed batch is left as it is."""
    spark = next(iter(frames.values())).sparkSession
    if path_exists(spark, _manifest(sink_dir, batch_id)):
        return
    attempt = f"a{uuid.uuid4().hex}"  # never read as a number
    for name, frame in frames.items():
        frame.write.parquet(f"{sink_dir}/{name}/{BATCH}={batch_id}/{ATTEMPT}={attempt}")
    write_text(spark, _manifest(sink_dir, batch_id), f'{{"{BATCH}": {batch_id}, "{ATTEMPT}": "{attempt}"}}\n')


def commits(spark: SparkSession, sink_dir: str) -> DataFrame:
    """``batch_id, attempt`` of every committed batch; a manifest that is still being written is none."""
    if not path_exists(spark, f"{sink_dir}/{COMMITS}"):
        return spark.createDataFrame([], _COMMIT_SCHEMA)
    return spark.read.schema(_COMMIT_SCHEMA).json(f"{sink_dir}/{COMMITS}").where(f"{BATCH} IS NOT NULL AND {ATTEMPT} IS NOT NULL")


def read_committed(spark: SparkSession, sink_dir: str, name: str, schema=None) -> DataFrame:
    """The rows of part ``name`` (``scored`` or ``rejected``) of committed batches, with ``batch_id``.

    The manifests are joined on the folders' names, so Spark skips the files of
    other attempts.  ``schema`` (without the folders' columns) is needed only
    where no batch has been written yet.
    """
    done = commits(spark, sink_dir)
    if not path_exists(spark, f"{sink_dir}/{name}") or not done.limit(1).count():
        if schema is None:
            raise FileNotFoundError(f"no committed batch under {sink_dir}")
        return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(None).cast("long"))
    reader = spark.read.option("basePath", f"{sink_dir}/{name}")
    rows = (reader if schema is None else reader.schema(schema)).parquet(f"{sink_dir}/{name}")
    # a row a batch
    return rows.withColumns({BATCH: F.col(BATCH).cast("long"), ATTEMPT: F.col(ATTEMPT).cast("string")}).join(
        done, [BATCH, ATTEMPT]).drop(ATTEMPT)


def start_scoring_stream(spark: SparkSession, model: PipelineModel, source_dir: str, sink_dir: str,
                         checkpoint_dir: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the query; :func:`read_committed` reads its output, ``sink_dir/scored`` and ``sink_dir/rejected``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = parse_requests(reader.text(source_dir))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(dict(zip(PARTS, score_requests(batch, model))), sink_dir, batch_id)
        finally:
            batch.unpersist()

    writer = requests.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(write)
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    return writer.trigger(**trigger).start()
