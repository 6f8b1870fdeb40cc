"""What a failure in the middle leaves: stream batches, saved models, runs tables, random splits, layouts."""

import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskfold.operators import prep, split
from riskfold.plans import train
from riskfold.roles import Roles
from riskfold.session import file_names, new_version, path_exists, shared_path, write_text
from riskfold.sources import bundles, runs
from riskfold.streaming import score_stream


def frames(spark, n, name="a"):
    rows = spark.range(n).select(F.concat(F.lit(name), F.col("id").cast("string")).alias("customer_id"))
    return {"scored": rows, "rejected": rows.limit(1).withColumn("reason", F.lit("x"))}


def test_a_batch_that_fails_between_its_writes_shows_neither_half(spark):
    sink = new_version(shared_path(spark, "test-stream"))
    with pytest.raises(FileNotFoundError):
        score_stream.read_committed(spark, sink, "scored")
    assert score_stream.read_committed(spark, sink, "scored", "customer_id string").count() == 0
    score_stream.write_batch(frames(spark, 3), sink, 0)
    broken = frames(spark, 5, "b")
    broken["rejected"] = broken["rejected"].select(F.raise_error(F.lit("lost")).alias("customer_id"), F.lit("x").alias("reason"))
    with pytest.raises(Exception, match="lost"):
        score_stream.write_batch(broken, sink, 1)
    assert spark.read.parquet(f"{sink}/scored").count() == 8  # the first half is there, and not committed
    assert score_stream.read_committed(spark, sink, "scored").count() == 3
    assert score_stream.read_committed(spark, sink, "rejected").count() == 1
    score_stream.write_batch(frames(spark, 5, "b"), sink, 1)  # the batch is repeated
    score_stream.write_batch(frames(spark, 5, "b"), sink, 1)  # and once more, after its manifest
    scored = score_stream.read_committed(spark, sink, "scored")
    assert sorted((r["batch_id"], r["customer_id"]) for r in scored.collect()) == [
        *[(0, f"a{i}") for i in range(3)], *[(1, f"b{i}") for i in range(5)]]
    assert score_stream.read_committed(spark, sink, "rejected").count() == 2
    write_text(spark, f"{sink}/commits/00000000000000000002.json", '{"batch_id": 2, "att')  # a manifest half written
    assert score_stream.read_committed(spark, sink, "scored").count() == 8


# ---- bundles ----

def small_model(spark):
    df = spark.createDataFrame([(float(i), str(i % 3), float(i % 2)) for i in range(20)], "x double, c string, y double")
    roles = Roles.of(df, id_cols=(), label_col="y", categorical=("c",))
    return Pipeline(stages=prep.preparation_stages(roles)).fit(df)


def file_of(path, part):
    import glob

    return sorted(glob.glob(f"{path.removeprefix('file:')}/{part}"))[0]


def test_a_bundle_names_what_is_missing_cut_or_changed(spark):
    model, base = small_model(spark), new_version(shared_path(spark, "test-bundles"))
    path = train.save(model, base)
    assert train.load(path).stages and train.load(base).stages
    manifest = bundles.read_manifest(spark, path)
    assert (manifest["numeric"], manifest["categorical"]) == (["x"], ["c"]) and len(manifest["files"]) >= 5

    def refused(match):
        with pytest.raises(bundles.BundleError, match=match) as e:
            train.load(path)
        return e.value

    victim = file_of(path, "stages/1_*/data/*.parquet")
    import os

    os.remove(os.path.join(os.path.dirname(victim), f".{os.path.basename(victim)}.crc"))  # a store without checksums of its own
    with open(victim, "rb") as f:
        held = f.read()
    with open(victim, "wb") as f:
        f.write(held[:-1])
    assert len(refused(r"data/part-.* has \d+ bytes of").problems) == 1
    with open(victim, "wb") as f:
        f.write(bytes([held[0] ^ 1]) + held[1:])
    refused("data/part-.* has other contents")
    assert len(bundles.verify(spark, path, contents=False)["files"]) == len(manifest["files"])
    os.remove(victim)
    refused("stages/1_.*/data/part-.* is missing")
    with open(victim, "wb") as f:
        f.write(held)
    assert train.load(path).stages
    write_text(spark, f"{path}/more.txt", "x")
    refused("more.txt is not in the manifest")


def test_a_version_without_manifest_is_refused(spark):
    path = new_version(shared_path(spark, "test-bundles"))
    small_model(spark).write().save(path)
    with pytest.raises(bundles.BundleError, match="_MANIFEST.json is missing"):
        train.load(path)
    with pytest.raises(FileNotFoundError):
        train.load(path + "-none")


# ---- runs ----

def record(name, i):
    return {"model_name": name, "model_path": f"m/{name}/{i}", "created_at": "2026-01-01T00:00:00.000Z", "params": f'{{"i": {i}}}',
            "id_cols": ["a", "b"], "class_weights": {"0": 0.5, "1": 2.0}, "auc": 0.5, "tp": i}


def test_500_appends_of_two_writers_and_compactions_between(spark):
    path = new_version(shared_path(spark, "test-runs"))
    with pytest.raises(FileNotFoundError):
        runs.read_runs(spark, path)
    errors = []

    def write(name):
        try:
            for i in range(250):
                runs._append(spark, record(name, i), path)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(n,)) for n in ("one", "two")]
    for w in writers:
        w.start()
    while not path_exists(spark, f"{path}/log"):
        pass
    for _ in range(3):  # while both append
        runs.compact_runs(spark, path)
    for w in writers:
        w.join()
    assert not errors
    assert runs.read_runs(spark, path).count() == 500
    for _ in range(2):
        runs.compact_runs(spark, path)
    got = runs.read_runs(spark, path).collect()
    assert sorted((r["model_name"], r["tp"]) for r in got) == [(n, i) for n in ("one", "two") for i in range(250)]
    assert all(r["id_cols"] == ["a", "b"] and r["class_weights"] == {"0": 0.5, "1": 2.0} and r["created_at"].year == 2026 for r in got)
    assert file_names(spark, f"{path}/log") == []
    write_text(spark, f"{path}/log/e-half.json", '{"model_name": "half", "tp": 1')
    runs._append(spark, record("last", 1), path)
    assert runs.read_runs(spark, path).count() == 501
    info = {r["model_name"]: r["n_versions"] for r in runs.model_info(spark, path).collect()}
    assert info == {"one": 250, "two": 250, "last": 1}


# ---- one draw, one layout ----

def test_a_random_split_is_one_draw(spark):
    table = spark.range(4000).withColumn("x", F.col("id") % 7).repartition(5)
    for layout in (table, table.repartition(3), table.coalesce(1)):
        a, b = split.random_split(layout)
        # read again after the layout's own order has changed
        first, second = ({r["id"] for r in d.repartition(11).collect()} for d in (a, b))
        assert first | second == set(range(4000)) and not first & second
        assert {r["id"] for r in a.collect()} == first and 3000 < len(first) < 3400


def test_dealt_rows_do_not_depend_on_the_input_layout(spark):
    rows = [(i % 50, float(i % 7) if i % 5 else None, f"c{i % 3}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, x double, c string")
    layout = lambda d: train.dealt(d, ["k"], 6, ["x", "c"]).select(
        F.spark_partition_id().alias("p"), "x", "c").collect()
    want = layout(df.repartition(1))
    for n in (3, 8):
        assert layout(df.repartition(n)) == want
    with pytest.raises(ValueError, match="num_partitions"):
        train.fit(df.withColumn("y", F.lit(1)), Roles.of(df.withColumn("y", F.lit(1)), id_cols=("k",), label_col="y", categorical=("c",)),
                  preset="quick", row_key=["k"])


def test_a_dealt_fit_gives_the_same_trees_in_every_layout(spark):
    rows = [(i, i % 40, float((i * 37) % 101), f"c{i % 4}", int((i * 37) % 101 + i % 9 > 60)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, k int, x double, c string, y int")
    roles = Roles.of(df, id_cols=("id", "k"), label_col="y", categorical=("c",))
    options = dict(preset="quick", id_col="id", num_partitions=4, row_key=["id"], maxIter=3, subsamplingRate=0.5)
    digests = [train.model_digest(train.fit(df.repartition(n), roles, **options).model) for n in (1, 5)]
    assert digests[0] == digests[1]
    assert train.model_digest(train.fit(df, roles, **{**options, "seed": 7}).model) != digests[0]
