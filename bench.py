"""Benchmark the headline queries.

Runs each headline key on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``, writing every output row to the ``noop`` sink
so the whole plan executes.  One warm-up run, then the median of
``$BENCH_REPS`` (default 3) timed runs.  Prints one JSON line.

Each timed run builds the query from scratch (input tables, plan, the
scorecard's materialised daily table) and executes it.  The output
normalisation that ``queries()`` adds for the cross-engine compare (every
double rounded twice) is not part of a query and is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["route_demand", "refund_ledger", "refund_status_union", "search_dashboard",
            "scorecard_daily", "scorecard_final"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    keys = os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",")

    from opscore.session import local_session
    shuffle = int(os.environ.get("BENCH_SHUFFLE", str(2 * int(cpus))))
    spark = local_session(cpus, shuffle_partitions=shuffle, app="opscore-bench")
    from opscore import registry
    from opscore.sources import DriverTables
    builders = registry.builders()

    def run(key: str) -> float:
        t0 = time.perf_counter()
        df = builders[key](DriverTables(spark, sf_dir))
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for key in keys:
        run(key)
        times[key] = round(statistics.median(run(key) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_val, "cpus": cpus,
                      "reps": reps}))


if __name__ == "__main__":
    main()
