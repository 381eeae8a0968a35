"""Stage timings of one registered query, from Spark's event log (a local
diagnostic: it starts its own local[8] session).

usage: python scripts/stage_times.py QUERY [SF_DIR] [--top N]

Runs the query once untimed at its scale (warm-up, fixture inputs), then
once more with the event log written to a fresh scratch folder, and prints
the timed jobs and the slowest stages with their task counts and the plan
operators they ran. No UI or port is involved.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(folder: str):
    import zstandard

    for f in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("query")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--top", type=int, default=12)
    args = ap.parse_args(argv)

    log_dir = tempfile.mkdtemp(prefix="vartab-evlog-")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("stage-times")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", "32")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from vartab.plans.queries import QUERIES
    from vartab.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    fn = QUERIES[args.query]
    fn(spark, args.sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("TIMED", args.query)
    t = time.perf_counter()
    fn(spark, args.sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t
    spark.stop()

    jobs, stage_job, stages = {}, {}, []
    for e in _events(log_dir):
        ev = e["Event"]
        if ev == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "TIMED":
            jobs[e["Job ID"]] = e["Submission Time"]
            for sid in e["Stage IDs"]:
                stage_job[sid] = e["Job ID"]
        elif ev == "SparkListenerStageCompleted" and e["Stage Info"]["Stage ID"] in stage_job:
            si = e["Stage Info"]
            ops = sorted({json.loads(r["Scope"])["name"] for r in si["RDD Info"] if r.get("Scope")})
            stages.append(((si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                           si["Stage ID"], si["Number of Tasks"], ops))
    print(f"{args.query} at {args.sf_dir}: {wall:.2f}s wall, {len(jobs)} jobs, {len(stages)} stages"
          f" (event log in {log_dir})")
    for dur, sid, tasks, ops in sorted(stages, reverse=True)[: args.top]:
        print(f"  {dur:6.2f}s stage {sid:4d} tasks {tasks:4d}  {', '.join(ops)[:110]}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
