"""Benchmark the headline queries.

Runs each key once to warm up, then ``BENCH_REPS`` times (default 5) with a
``noop`` write (every row materialised, nothing collected), and reports the
median per key. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPS (default 5), BENCH_KEYS (comma list, default headline keys)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigil.plans.catalog import QUERIES  # noqa: E402
from vigil.session import get_session  # noqa: E402

HEADLINE = ("rule_account", "rule_passport", "rule_city", "rule_amount", "scd2_apply",
            "report_all")


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                          r"RoundRobinPartitioning)", plan))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    keys = [k for k in os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",") if k]
    spark = get_session(f"local[{cpus}]", app="vigil-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    exchanges: dict[str, int] = {}
    for key in keys:
        build = QUERIES[key]
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            df = build(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(runs), 4)
        exchanges[key] = _exchanges(build(spark, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "median seconds per query, summed over headline keys",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
        "exchanges": exchanges,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
