"""Command line: run the daily pipeline or the training job.

    python -m tidemark daily --raw-dir DIR --warehouse DIR [--model DIR]
    python -m tidemark train --warehouse DIR --model DIR [--run-id NAME]

The Spark master and all cluster settings come from ``spark-submit`` /
the environment; ``spark.checkpoint.dir`` must name a shared folder on a
cluster.
"""

from __future__ import annotations

import argparse
import json

from .plans import daily
from .session import get_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="gates, raw load, marts, checks and (optionally) scoring")
    d.add_argument("--raw-dir", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--model")
    d.add_argument("--strict-nulls", action="store_true")
    t = sub.add_parser("train", help="fit the churn model on the LTV mart")
    t.add_argument("--warehouse", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--run-id", help="name of this training; a repeated one takes its own place on record")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None
    spark = get_session("tidemark-" + a.cmd)
    if a.cmd == "daily":
        res = daily.run_daily(spark, a.raw_dir, a.warehouse, strict_nulls=a.strict_nulls,
                              model_path=a.model)
        for r in res.summary.collect():
            print(json.dumps({k: (str(v) if v is not None else None) for k, v in r.asDict().items()}))
        if res.scoring is not None:
            print(json.dumps({"scored": res.scoring.first().customers_scored}))
        print(res.profile())
    else:
        rec = daily.run_training(spark, a.warehouse, a.model, run_id=a.run_id)
        print(json.dumps({k: v for k, v in rec.items() if k != "report"}, default=str))
        for row in rec["report"]:
            print(json.dumps(row))
    if owned:
        spark.stop()


if __name__ == "__main__":
    main()
