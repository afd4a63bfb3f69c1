"""Time the oracle SQL of keys on DuckDB (single node, same machine) as a
comparison point for bench.py.  Median of 3 after one warm-up.

    python tools/duck_bench.py [--sf DIR] key ...
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.check import duck  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from opscore import registry
    oracle = registry.oracle_sql()
    out = {}
    for k in a.keys or sorted(oracle):
        con = duck(a.sf)
        sql = oracle[k]
        con.sql(sql).fetchall()
        ts = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.sql(sql).fetchall()
            ts.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(ts), 3)
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
