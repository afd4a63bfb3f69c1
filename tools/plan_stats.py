"""Summarise physical plans of registered keys: exchanges, join kinds, reuse.

    python tools/plan_stats.py [--sf DIR] [--show] key ...
"""

from __future__ import annotations

import argparse
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opscore.session import local_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window",
         "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Scan parquet",
         "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "Generate", "Expand"]


def plan_text(df, mode="formatted") -> str:
    return df._jdf.queryExecution().executedPlan().toString() if mode == "raw" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def stats(text: str) -> Counter:
    c = Counter()
    for line in text.splitlines():
        for n in NODES:
            if re.search(r"\b" + re.escape(n), line):
                c[n] += 1
    return c


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan
    from opscore import registry
    qs = registry.queries()
    for k in a.keys or sorted(qs):
        df = qs[k](spark, a.sf)
        txt = df._jdf.queryExecution().executedPlan().toString()
        st = stats(txt)
        print(k, dict(sorted(st.items())))
        if a.show:
            print(txt)
    return 0


if __name__ == "__main__":
    sys.exit(main())
