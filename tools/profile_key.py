"""Run one key with Spark's event log in a scratch folder and summarise jobs
and stages (wall time, tasks, shuffle bytes).  No UI or server involved.

    python tools/profile_key.py [--sf DIR] key
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--top", type=int, default=15)
    ap.add_argument("key")
    a = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from opscore import registry
    df = registry.queries()[a.key](spark, a.sf)
    df.write.format("noop").mode("overwrite").save()  # warm
    t0 = time.perf_counter()
    df = registry.queries()[a.key](spark, a.sf)
    df.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()
    files = [f for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True)
             if os.path.isfile(f) and "events" in os.path.basename(f)]
    lines = [ln for f in sorted(files) for ln in open(f)]
    jobs, stages = {}, []
    for line in lines:
        ev = json.loads(line)
        e = ev.get("Event")
        if e == "SparkListenerJobStart":
            jobs[ev["Job ID"]] = [ev["Submission Time"], None, len(ev.get("Stage IDs", []))]
        elif e == "SparkListenerJobEnd":
            jobs[ev["Job ID"]][1] = ev["Completion Time"]
        elif e == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            if "Submission Time" not in info:
                continue
            acc = {x["Name"]: x.get("Value") for x in info.get("Accumulables", [])}
            stages.append((info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                           info["Number of Tasks"], info["Stage Name"][:60],
                           acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                           acc.get("internal.metrics.input.recordsRead", 0),
                           int(acc.get("internal.metrics.memoryBytesSpilled", 0) or 0),
                           int(acc.get("internal.metrics.diskBytesSpilled", 0) or 0),
                           ev.get("Stage Info", {}).get("Stage ID")))
    half = sorted(jobs)[len(jobs) // 2:]
    timed_stages = set()
    for line in lines:
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerJobStart" and ev["Job ID"] in half:
            timed_stages.update(ev.get("Stage IDs", []))
    done = [s for s in stages if s[1] in timed_stages]
    print(f"  timed run: shuffle write {sum(int(s[4] or 0) for s in done) / 1e6:.1f} MB, "
          f"spill memory {sum(s[6] for s in done) / 1e6:.1f} MB, "
          f"spill disk {sum(s[7] for s in done) / 1e6:.1f} MB")
    print(f"{a.key}: wall {wall:.2f}s, jobs total {len(jobs)} (second run ~{len(half)})")
    span = [(v[1] - v[0]) for k, v in jobs.items() if v[1]]
    print(f"  sum of job times {sum(span)/1000:.2f}s")
    first = min(v[0] for k, v in jobs.items() if k in half) if half else 0
    print("  timeline of the timed run (ms from its first job):")
    for k in half:
        st, en, ns = jobs[k]
        print(f"    job {k:4d} start {st - first:6d} end {(en or st) - first:6d} "
              f"dur {(en or st) - st:5d} stages {ns}")
    for s in sorted(stages, reverse=True)[: a.top]:
        print(f"  stage {s[1]:4d} {s[0]:6d}ms tasks={s[2]:4d} shuffleW={s[4]} in={s[5]} {s[3]}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
