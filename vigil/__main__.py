"""Daily run from the command line (``python -m vigil``, or this file with spark-submit).

    python -m vigil --landing DIR --warehouse DIR --seeds DIR [--run-time ISO] [--show N]

``--seeds`` holds ``clients``, ``accounts`` and ``cards`` as Parquet tables in
the seed shape (see ``vigil.schemas``). Every complete pending day in the
landing folder is processed; the report rows of those days are summarised per
event type and, with ``--show``, displayed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigil.operators.seqlag import DEFAULT_GROUP_ROWS
from vigil.plans import daily
from vigil.schemas import SEED_ACCOUNTS, SEED_CARDS, SEED_CLIENTS
from vigil.session import get_session


def read_seeds(spark: SparkSession, folder: str):
    return (spark.read.schema(SEED_CLIENTS).parquet(f"{folder}/clients"),
            spark.read.schema(SEED_ACCOUNTS).parquet(f"{folder}/accounts"),
            spark.read.schema(SEED_CARDS).parquet(f"{folder}/cards"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[dt.date]:
    ap = argparse.ArgumentParser(prog="vigil", description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--seeds", required=True)
    ap.add_argument("--run-time", help="load and report time (ISO, UTC); default: now")
    ap.add_argument("--show", type=int, default=0, help="display up to N report rows")
    ap.add_argument("--max-group-rows", type=int, default=DEFAULT_GROUP_ROWS,
                    help="rows per card and day above which a card is sliced (hot card)")
    ap.add_argument("--fact-buckets", type=int, default=0,
                    help="keep the facts as a table bucketed by card into N buckets")
    args = ap.parse_args(argv)
    spark = spark or get_session()
    run_time = (dt.datetime.fromisoformat(args.run_time) if args.run_time
                else dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0))
    wh = daily.Warehouse(args.warehouse, fact_buckets=args.fact_buckets or None)
    done = daily.run_daily(spark, args.landing, wh, read_seeds(spark, args.seeds), run_time,
                           max_group_rows=args.max_group_rows)
    print(f"processed batches: {[d.isoformat() for d in done]}")
    if done:
        rep = daily.read_report(spark, wh).filter(F.col("batch_date").isin(done))
        rep.groupBy("batch_date", "event_type").count().orderBy("batch_date", "event_type").show(
            truncate=False)
        if args.show:
            rep.orderBy("batch_date", "event_type", "event_dt").show(args.show, truncate=False)
    return done


if __name__ == "__main__":
    main(sys.argv[1:])
