"""The command-line jobs, end to end on a table written from the fixture."""

import json

from riskfold import cli
from riskfold.sources import fixtures, requests as req
from tests.conftest import SF001


def test_train_score_stream_info(spark, tmp_path, capsys):
    data = str(tmp_path / "statements")
    fixtures.statements(spark, SF001).write.parquet(data)
    roles = ["--id-cols", "customer_id,line_no,date,test", "--label", "target",
             "--categorical", "c_flag,c_status,c_rare"]
    model, runs = str(tmp_path / "model"), str(tmp_path / "runs")
    cli.main(["train", "--input", data, "--model", model, "--runs", runs, "--preset", "quick", *roles], spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["auc"] > 0.9 and sorted(out["dropped"]) == ["c_rare", "n_sparse"] and out["model"].startswith(model + "/v")

    cli.main(["score", "--input", data, "--model", model, "--out", str(tmp_path / "scored"),
              "--id-col", "customer_id"], spark)
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.count() == 6000 and set(scored.columns) == {"customer_id", "prediction", "probability", "risk_level"}

    src = str(tmp_path / "requests")
    req.lineitem_requests(spark, SF001).write.json(src)
    cli.main(["score", "--input", src, "--model", model, "--out", str(tmp_path / "bulk"), "--requests"], spark)
    bulk = spark.read.parquet(str(tmp_path / "bulk" / "scored")).count()
    rejected = spark.read.parquet(str(tmp_path / "bulk" / "rejected")).count()
    assert bulk + rejected == 6000

    cli.main(["stream", "--source", src, "--model", model, "--out", str(tmp_path / "stream"),
              "--checkpoint", str(tmp_path / "ck")], spark)
    assert spark.read.parquet(str(tmp_path / "stream" / "scored")).count() == bulk

    cli.main(["profile", "--input", data, "--out", str(tmp_path / "profile"), *roles], spark)
    assert spark.read.parquet(str(tmp_path / "profile")).count() == 13
    cli.main(["info", "--runs", runs], spark)
    assert "credit_default_gbt" in capsys.readouterr().out
