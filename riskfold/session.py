"""Session-level helpers: the shared folder for checkpoints, models and runs.

Everything that outlives a job is written to a folder of its own (a version);
nothing is renamed or overwritten, so object stores need no special care.  A
version counts once its marker file exists, which is written last.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

COMPLETE = "_COMPLETE"


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder named by ``spark.checkpoint.dir``.

    The cluster names the shared folder; we only read it.  A local master
    with no such setting (tests, notebooks) gets a fresh temporary folder.
    On a real cluster a missing setting is an error: a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        root = tempfile.mkdtemp(prefix="riskfold-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (see :func:`shared_root`)."""
    return "/".join([shared_root(spark), *parts])


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def file_stamps(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and modification time of every file at or under ``path``, in name order."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    if fs.getFileStatus(jpath).isFile():
        s = fs.getFileStatus(jpath)
        return [(s.getPath().toString(), s.getLen(), s.getModificationTime())]
    out, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        s = files.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def new_version(base: str) -> str:
    """A folder name under ``base`` that no other writer uses; later ones sort last."""
    now = dt.datetime.now(dt.timezone.utc)
    return f"{base.rstrip('/')}/v{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def mark_complete(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, f"{path}/{COMPLETE}")
    fs.create(jpath, True).close()
    return path


def versions(spark: SparkSession, base: str) -> list[str]:
    """The complete versions under ``base``, oldest first."""
    fs, jpath = _fs(spark, base)
    if not fs.exists(jpath):
        return []
    found = [s.getPath() for s in fs.listStatus(jpath) if s.isDirectory() and s.getPath().getName().startswith("v")]
    names = sorted(p.getName() for p in found)
    return [f"{base.rstrip('/')}/{n}" for n in names if path_exists(spark, f"{base.rstrip('/')}/{n}/{COMPLETE}")]


def publish(spark: SparkSession, write, base: str) -> str:
    """Run ``write(path)`` on a fresh version under ``base`` and return its path.

    Readers see the version only once it is whole; other versions stay.
    """
    path = new_version(base)
    write(path)
    return mark_complete(spark, path)


def written_table(spark: SparkSession, name: str, build) -> DataFrame:
    """The oldest version of table ``name`` in the shared folder, written with ``build()`` if there is none.

    ``name`` must identify the content: two writers at once write the same
    rows twice, and all readers agree on one of the copies.
    """
    base = shared_path(spark, "riskfold", "tables", name)
    if not versions(spark, base):
        publish(spark, lambda path: build().write.parquet(path), base)
    return spark.read.parquet(versions(spark, base)[0])


def fresh_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: a step that is not computed twice."""
    path = shared_path(df.sparkSession, "riskfold", "steps", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, through Hadoop's FileSystem."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, through Hadoop's FileSystem."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small text file, through Hadoop's FileSystem; it must not be there unless ``overwrite``."""
    fs, jpath = _fs(spark, path)
    stream = fs.create(jpath, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right under ``path``, sorted; none if there is no such folder."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile())
