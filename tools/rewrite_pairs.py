"""Time rewrite pairs on Spark: the warehouse form vs the form this library
uses, after checking both give the same rows.

    python tools/rewrite_pairs.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from opscore.session import local_session  # noqa: E402


def timed(df, reps=3) -> float:
    df.write.format("noop").mode("overwrite").save()
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    spark = local_session(8, 16)
    from opscore.functions import Bands, band_score
    from opscore.functions.calendar import month_key
    from opscore.operators import (latest_per_key, normalised, partition_count,
                                   rolling_days_filter, status_in_filter)
    from opscore.plans.scorecard import SHIFT_INDICATORS, Scorecard
    from opscore.registry import PARAMS as P
    from opscore.sources import DriverTables
    t = DriverTables(spark, a.sf)

    s = t["searches"].select("id", "iata_from", "iata_to")
    o = status_in_filter(rolling_days_filter(t["orders_booked"], "created_at", P["route_as_of"],
                                             P["route_days"]), "last_status", (56, 60))
    o = o.select(F.col("id").alias("_oid"), "fk_search_id", "created_at")
    tr = rolling_days_filter(t["order_tracking"], "created_at", P["route_as_of"],
                             P["route_days"]).select("fk_order_id", "source")
    rows = s.join(o, s["id"] == o["fk_search_id"]).join(tr, F.col("_oid") == tr["fk_order_id"])
    rows = rows.select("iata_from", "iata_to", "id", "fk_search_id", "created_at", "source")

    pairs = []
    # W1: newest row per route
    w = Window.partitionBy("iata_from", "iata_to").orderBy(
        F.col("created_at").desc(), F.col("fk_search_id").desc(), F.col("source").desc())
    win = (rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
           .select("iata_from", "iata_to", "fk_search_id", "created_at", "source"))
    agg = latest_per_key(rows, ["iata_from", "iata_to"], ["created_at", "fk_search_id", "source"],
                         ["fk_search_id", "created_at", "source"])
    pairs.append(("W1 newest sale per route", win, agg))
    # W2: count on every row
    wc = rows.withColumn("n", F.count("id").over(Window.partitionBy("iata_from", "iata_to")))
    jc = partition_count(rows, ["iata_from", "iata_to"], "id", "n")
    pairs.append(("W2 route count on every row", wc.select(*jc.columns), jc))
    # D12: shift-specific targets
    sc = Scorecard(t, P["start_date"], P["shift_from"], P["as_of_ts"])
    base = sc.production_with_absence.withColumn("_ym", month_key("data_resolucao"))
    tg = t["targets"]
    arms = []
    for shift, ind in SHIFT_INDICATORS.items():
        ti = tg.filter((F.lower("indicador") == ind) & (normalised("tipo") == "individual")
                       & (F.upper("origem") == "PRIMARIO")).withColumn("_tym", month_key("ref"))
        j = base.filter(F.col("escala") == shift).join(ti, base["_ym"] == ti["_tym"])
        arms.append(j.select("data_resolucao", "matricula", "producao",
                             band_score("producao", Bands(), above="extrapolate")
                             .alias("p_produtividade")))
    tri = arms[0].union(arms[1]).union(arms[2]).distinct()
    pairs.append(("D12 three joins + UNION vs one join", tri, sc.production_score))

    for name, warehouse, ours in pairs:
        ok = same(warehouse, ours)
        tw, to = timed(warehouse), timed(ours)
        print(f"{name:40s} same={ok} warehouse={tw:.3f}s library={to:.3f}s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
