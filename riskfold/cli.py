"""Command-line jobs (``spark-submit riskfold/cli.py <job> ...`` or ``python -m riskfold.cli``).

    profile --input T [--out P]                      null/NaN profile of a Parquet table
    train   --input T --model M [--runs R] [--preset script|notebook|quick]
            writes a new version under M; the other jobs read the newest one
    score   --input T --model M --out P [--requests] bulk scoring (typed rows or request JSON)
    stream  --source D --model M --out P --checkpoint C [--continuous]
    info    --runs R                                 latest run per model name

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory and ``spark.checkpoint.dir`` are whatever ``spark-submit`` configured.
Column roles default to the statement data set's names and can be changed
with ``--id-cols``, ``--label`` and ``--categorical``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from riskfold.roles import DEFAULT_CATEGORICAL_COLS, DEFAULT_ID_COLS, DEFAULT_LABEL_COL, Roles  # noqa: E402


def _roles(df, args) -> Roles:
    return Roles.of(
        df, id_cols=tuple(args.id_cols.split(",")), label_col=args.label,
        categorical=tuple(args.categorical.split(",")) if args.categorical else (),
    )


def cmd_profile(spark, args):
    from riskfold.operators.profile import null_nan_percent

    df = spark.read.parquet(args.input)
    prof = null_nan_percent(df, _roles(df, args))
    if args.out:
        prof.write.mode("overwrite").parquet(args.out)
    else:
        prof.orderBy("column_name").show(len(df.columns), truncate=False)


def cmd_train(spark, args):
    from riskfold.operators.evaluate import metric_report
    from riskfold.operators.prep import feature_input_cols
    from riskfold.plans import train as T
    from riskfold.sources import runs

    df = spark.read.parquet(args.input)
    roles = _roles(df, args)
    trained = T.fit(df, roles, preset=args.preset, id_col=args.split_col or roles.id_cols[0], seed=args.seed,
                    num_partitions=args.partitions)
    path = T.save(trained.model, args.model)
    scored = T.scored_rows(trained.model, trained.test, [roles.label_col])
    metrics = metric_report(scored, roles.label_col, "prob").first().asDict()
    if args.runs:
        rec = runs.run_record(spark, args.name, path, trained, metrics, feature_input_cols(trained.roles))
        runs.append_run(rec, args.runs)
    print(json.dumps({"model": path, "dropped": trained.dropped, **metrics}, default=str))


def cmd_score(spark, args):
    from riskfold.plans import score as S
    from riskfold.plans.train import load
    from riskfold.sources.requests import read_requests

    model = load(args.model)
    if args.requests:
        scored, rejected = S.score_requests(read_requests(spark, args.input), model)
        rejected.write.mode("overwrite").parquet(args.out + "/rejected")
        scored.write.mode("overwrite").parquet(args.out + "/scored")
    else:
        S.score(spark.read.parquet(args.input), model, id_col=args.id_col).write.mode("overwrite").parquet(args.out)


def cmd_stream(spark, args):
    from riskfold.plans.train import load
    from riskfold.streaming import start_scoring_stream

    start_scoring_stream(spark, load(args.model), args.source, args.out, args.checkpoint,
                         available_now=not args.continuous).awaitTermination()


def cmd_info(spark, args):
    from riskfold.sources.runs import model_info

    info = model_info(spark, args.runs)
    info.show(truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="riskfold")
    sub = p.add_subparsers(dest="cmd", required=True)

    def roles_args(sp):
        sp.add_argument("--id-cols", default=",".join(DEFAULT_ID_COLS))
        sp.add_argument("--label", default=DEFAULT_LABEL_COL)
        sp.add_argument("--categorical", default=",".join(DEFAULT_CATEGORICAL_COLS))

    sp = sub.add_parser("profile")
    sp.add_argument("--input", required=True)
    sp.add_argument("--out")
    roles_args(sp)

    sp = sub.add_parser("train")
    sp.add_argument("--input", required=True)
    sp.add_argument("--model", required=True)
    sp.add_argument("--runs")
    sp.add_argument("--name", default="credit_default_gbt")
    sp.add_argument("--preset", default="script", choices=["script", "notebook", "quick"])
    sp.add_argument("--split-col", default=None, help="hash-split key (default: first id column)")
    sp.add_argument("--seed", type=int, default=42)
    sp.add_argument("--partitions", type=int, default=None, help="deal the training rows out over so many partitions")
    roles_args(sp)

    sp = sub.add_parser("score")
    sp.add_argument("--input", required=True)
    sp.add_argument("--model", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--requests", action="store_true", help="input is JSON requests {customer_id, features}")
    sp.add_argument("--id-col", default=DEFAULT_ID_COLS[0])

    sp = sub.add_parser("stream")
    sp.add_argument("--source", required=True)
    sp.add_argument("--model", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--checkpoint", required=True)
    sp.add_argument("--continuous", action="store_true", help="keep running (10 s micro-batches)")

    sp = sub.add_parser("info")
    sp.add_argument("--runs", required=True)
    return p


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"riskfold-{args.cmd}").getOrCreate()
    {"profile": cmd_profile, "train": cmd_train, "score": cmd_score,
     "stream": cmd_stream, "info": cmd_info}[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
