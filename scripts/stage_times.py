"""Stage and task times of catalog keys from Spark's event log.

usage: python scripts/stage_times.py sf_dir key [key ...]

Runs each key twice (the second run is reported) with the event log written to
a fresh scratch folder under /tmp, then prints the slowest stages with their
task count, run time and CPU time.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.plans.catalog import QUERIES  # noqa: E402
from vigil.session import get_session  # noqa: E402


def _events(folder: str):
    import zstandard
    for path in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        with open(path, "rb") as fh:
            stream = fh
            if path.endswith(".zstd"):
                stream = zstandard.ZstdDecompressor().stream_reader(fh)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    sf_dir, keys = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="vigil-eventlog-", dir="/tmp")
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    for key in keys:
        for rep in range(2):
            spark.sparkContext.setJobGroup(f"{key}#{rep}", key)
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    job_group, stage_group, stages, tasks = {}, {}, {}, {}
    for e in _events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            job_group[e["Job ID"]] = group
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                        info["Number of Tasks"], info["Stage Name"][:60])
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            t = tasks.setdefault(e["Stage ID"], [0, 0])
            t[0] += m.get("Executor Run Time", 0)
            t[1] += m.get("Executor CPU Time", 0) // 1_000_000
    for key in keys:
        ids = [s for s, g in stage_group.items() if g == f"{key}#1" and s in stages]
        total = sum(stages[s][0] for s in ids)
        print(f"{key}: {len(ids)} stages, {total} ms summed stage time")
        for s in sorted(ids, key=lambda s: -stages[s][0])[:6]:
            ms, n, name = stages[s]
            run, cpu = tasks.get(s, [0, 0])
            print(f"  stage {s:4d} {ms:6d} ms  tasks {n:3d}  run {run:6d} ms  cpu {cpu:6d} ms  {name}")


if __name__ == "__main__":
    main()
