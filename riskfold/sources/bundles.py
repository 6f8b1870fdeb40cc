"""Saved models as whole bundles: what belongs to a version, and whether it is all there.

``_MANIFEST.json`` in a version's folder names every data file with its length
and SHA-256, and the columns that the model reads.  It is written after the
model and before the version counts, so a version with no manifest is not
whole.  Loading compares names and lengths through Hadoop's FileSystem and
digests by a Spark job over the files, and refuses a version by naming what is
missing, cut or changed, before any of it is used.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.session import file_stamps, path_exists, read_text, write_text

MANIFEST = "_MANIFEST.json"


class BundleError(RuntimeError):
    """A saved version that is not whole; ``problems`` has a line for each file."""

    def __init__(self, path: str, problems: list[str]):
        super().__init__(f"{path} is not whole: " + "; ".join(problems))
        self.path, self.problems = path, problems


def _relative(path: str, file: str) -> str:
    """``file`` below ``path``; both may or may not carry a scheme."""
    plain = lambda p: p.split(":", 1)[1] if ":" in p.split("/", 1)[0] else p
    base, name = "/" + plain(path).strip("/") + "/", "/" + plain(file).lstrip("/")
    at = name.find(base)
    if at < 0:
        raise ValueError(f"{file} is not under {path}")
    return name[at + len(base):]


def lengths(spark: SparkSession, path: str) -> dict[str, int]:
    """Length of every data file under ``path`` by its relative name; files that Spark hides are none."""
    out = {}
    for name, size, _ in file_stamps(spark, path):
        below = _relative(path, name)
        if not any(p.startswith(("_", ".")) for p in below.split("/")):
            out[below] = size
    return out


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, sha256`` of every data file under ``path``, read by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def _digests(spark: SparkSession, path: str) -> dict[str, str]:
    # a row a file of one model
    return {_relative(path, r["path"]): r["sha256"] for r in digests(spark, path).collect()}


def write_manifest(spark: SparkSession, path: str, numeric, categorical) -> None:
    sizes, sums = lengths(spark, path), _digests(spark, path)
    files = [{"name": n, "length": sizes[n], "sha256": sums[n]} for n in sorted(sizes)]
    write_text(spark, f"{path}/{MANIFEST}", json.dumps(
        {"files": files, "numeric": list(numeric), "categorical": list(categorical)}, indent=1) + "\n")


def read_manifest(spark: SparkSession, path: str) -> dict:
    if not path_exists(spark, f"{path}/{MANIFEST}"):
        raise BundleError(path, [f"{MANIFEST} is missing"])
    try:
        return json.loads(read_text(spark, f"{path}/{MANIFEST}"))
    except ValueError as e:
        raise BundleError(path, [f"{MANIFEST} cannot be read: {e}"]) from e


def verify(spark: SparkSession, path: str, contents: bool = True) -> dict:
    """The manifest of the version at ``path``, or :class:`BundleError`.

    ``contents`` also compares digests, which reads every file once.
    """
    manifest = read_manifest(spark, path)
    found, problems = lengths(spark, path), []
    for f in manifest["files"]:
        if f["name"] not in found:
            problems.append(f"{f['name']} is missing")
        elif found[f["name"]] != f["length"]:
            problems.append(f"{f['name']} has {found[f['name']]} bytes of {f['length']}")
    problems += [f"{n} is not in the manifest" for n in sorted(set(found) - {f["name"] for f in manifest["files"]})]
    if contents and not problems:
        sums = _digests(spark, path)
        problems = [f"{f['name']} has other contents" for f in manifest["files"] if sums.get(f["name"]) != f["sha256"]]
    if problems:
        raise BundleError(path, problems)
    return manifest
