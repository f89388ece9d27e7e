"""Command line for the three pipeline steps.

    python -m keepwise extract --src TABLES --out RAW --as-of 2026-05-31
    python -m keepwise train   --features RAW/customer_data_20260531 --model MODEL
    python -m keepwise score   --src TABLES --model MODEL --store STORE --report REPORT --as-of 2026-05-31

``TABLES`` holds one Parquet folder per business table (customers,
user_activity, invoices, support_tickets, marketing_engagement). Run under
spark-submit on a cluster; ``--master`` is only for local use.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from . import config as C


def _session(args):
    from .session import build_session, size_shuffle_partitions

    spark = build_session(args.master)
    source = getattr(args, "src", None) or getattr(args, "features", None)
    if source and not source.startswith("jdbc:"):
        size_shuffle_partitions(spark, [source])
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="keepwise")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)

    ex = sub.add_parser("extract", help="feature table -> dated CSV folder")
    ex.add_argument("--src", required=True)
    ex.add_argument("--out", required=True)
    ex.add_argument("--as-of", required=True)
    ex.add_argument("--format", default="parquet", choices=["parquet", "csv", "jdbc"])
    ex.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="reader option, repeatable (a JDBC read needs its partitioning options)")

    tr = sub.add_parser("train", help="split, fit, cross-validate, evaluate, save")
    tr.add_argument("--features", required=True, help="CSV folder written by extract")
    tr.add_argument("--model", required=True)
    tr.add_argument("--folds", type=int, default=5)
    tr.add_argument("--trees", type=int, default=C.ForestParams.num_trees)
    tr.add_argument("--depth", type=int, default=C.ForestParams.max_depth)

    sc = sub.add_parser("score", help="score customers, store predictions, write the high-risk report")
    sc.add_argument("--src", required=True)
    sc.add_argument("--model", required=True)
    sc.add_argument("--store", required=True)
    sc.add_argument("--report", required=True)
    sc.add_argument("--as-of", required=True)
    sc.add_argument("--model-version", default=C.DEFAULT_MODEL_VERSION)

    args = ap.parse_args(argv)
    spark = _session(args)
    from .plans import jobs
    from .sources import tables as TB

    if args.cmd == "extract":
        as_of = dt.datetime.fromisoformat(args.as_of)
        tabs = TB.load_tables(spark, args.src, fmt=args.format, options=dict(o.split("=", 1) for o in args.option))
        path, summary = jobs.extract_features(tabs, as_of, args.out)
        print(json.dumps({"path": path, **summary.first().asDict()}))
    elif args.cmd == "train":
        from .operators.features import build_features

        # the CSV is read with the feature table's declared schema
        empty = {n: spark.createDataFrame([], TB.SCHEMAS[n]) for n in TB.BASE_TABLES}
        schema = build_features(empty, dt.datetime(2000, 1, 1)).schema
        feats = TB.read_csv(spark, args.features, schema)
        params = C.ForestParams(num_trees=args.trees, max_depth=args.depth)
        out = jobs.train_and_evaluate(feats, args.model, params, folds=args.folds)
        shown = {"accuracy": out["accuracy"].first()["accuracy"], "roc_auc": out["roc_auc"].first()["roc_auc"]}
        if "cross_validation" in out:
            shown["cross_validation"] = out["cross_validation"].first().asDict()
        print(json.dumps(shown))
    elif args.cmd == "score":
        from .operators.reports import rank_report

        as_of = dt.datetime.fromisoformat(args.as_of)
        tabs = TB.load_tables(spark, args.src)
        report = jobs.daily_scoring(spark, tabs, args.model, args.store, as_of, args.model_version)
        rank_report(report).write.mode("overwrite").parquet(args.report)
        print(json.dumps({"report": args.report}))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
