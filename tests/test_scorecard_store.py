"""The written scorecard: a refresh replaces the months it can reach and nothing else, and equals a full run."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL

STAMP = "2024-01-01 06:00:00"
START, SHIFT = "2001-01-01", "2001-03-01"


@pytest.fixture(scope="module")
def tables(spark):
    from opscore.sources import DriverTables
    t = DriverTables(spark, SF_SMALL)
    names = ["roster", "targets", "resolutions", "recontacts", "absences", "contact_calendar", "cycle_positions",
             "monthly_grades", "collective_extras", "losses", "csat_answers"]
    return {n: t[n] for n in names}


def same(a, b):
    def counted(df):
        text = [F.round(c, 6).cast("string") if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
        return Counter(tuple(r) for r in df.select(*text).collect())

    return counted(a) == counted(b)


def files(folder):
    return {(d, f) for top, _, names in os.walk(folder) for d in [os.path.relpath(top, folder)] for f in names
            if f.startswith("part-")}


def test_one_more_month_and_late_rows(spark, tables, tmp_path):
    from opscore.plans.scorecard import Scorecard
    from opscore.plans.scorecard_store import ScorecardStore, touched_months
    late = dt.date(2001, 9, 1)
    before = dict(tables)
    # September's resolutions come later, and some of May's recontacts and losses too
    before["resolutions"] = tables["resolutions"].filter(F.trunc("data_resolucao", "month") != F.lit(late))
    before["recontacts"] = tables["recontacts"].filter(
        (F.trunc("data_ultima_criacao", "month") != F.lit(dt.date(2001, 5, 1))) | (F.col("matricula") % 3 != 0)
        | F.col("data_ultima_criacao").isNull())
    before["losses"] = tables["losses"].filter(F.trunc("data_ref", "month") != F.lit(dt.date(2001, 5, 1)))
    changed = {n: tables[n].exceptAll(before[n]) for n in ("resolutions", "recontacts", "losses")}
    touched = touched_months(changed)
    assert dt.date(2001, 9, 1) in touched and dt.date(2001, 5, 1) in touched

    store = ScorecardStore(spark, str(tmp_path), START, SHIFT)
    store.build(before, STAMP)
    old = files(tmp_path)
    months = store.refresh(tables, touched, STAMP)
    full = Scorecard(tables, START, SHIFT, STAMP)
    assert same(store.daily, full.scorecard_daily)
    assert same(store.final, full.scorecard_final)
    # files of other months are the ones written before
    names = {f"ym={m.isoformat()}" for m in months}
    kept = {(d, f) for d, f in old if os.path.basename(d) not in names}
    assert kept and kept <= files(tmp_path)
    assert not {(d, f) for d, f in old if os.path.basename(d) in names} & files(tmp_path)


def test_a_month_that_loses_its_rows(spark, tables, tmp_path):
    from opscore.plans.scorecard import Scorecard
    from opscore.plans.scorecard_store import ScorecardStore
    gone = [dt.date(2001, 4, 1), dt.date(2001, 5, 1), dt.date(2001, 6, 1)]
    after = dict(tables)
    for name, col in (("contact_calendar", "created"), ("absences", "data_ref")):
        after[name] = tables[name].filter(~F.trunc(F.to_date(col), "month").isin(gone))
    store = ScorecardStore(spark, str(tmp_path), START, SHIFT)
    store.build(tables, STAMP)
    assert any("ym=2001-05-01" in d for d, _ in files(tmp_path))
    store.refresh(after, gone, STAMP)
    assert not any("ym=2001-05-01" in d for d, _ in files(tmp_path))
    full = Scorecard(after, START, SHIFT, STAMP)
    assert same(store.daily, full.scorecard_daily) and same(store.final, full.scorecard_final)


def test_refresh_reads_only_the_days_of_its_months(spark, tables):
    from opscore.plans.scorecard import Scorecard
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        card = Scorecard(tables, START, SHIFT, STAMP, months=[dt.date(2001, 9, 1)])
        plan = card.scorecard_daily._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_returnflag" in ln and "l_quantity" in ln and "l_suppkey" in ln]
    assert scans and all("GreaterThanOrEqual(l_shipdate,2001-08-26" in ln and "LessThan(l_shipdate,2001-10-01" in ln
                         for ln in scans)


def test_reached_months():
    from opscore.plans.scorecard_store import reached_months
    assert reached_months([dt.date(2021, 12, 30)]) == [dt.date(2021, 12, 1), dt.date(2022, 1, 1)]
    assert reached_months([]) == []


def test_months_before_the_start_are_no_work(spark, tables, tmp_path):
    from opscore.plans.scorecard_store import ScorecardStore
    store = ScorecardStore(spark, str(tmp_path), START, SHIFT)
    assert store.refresh(tables, [dt.date(1999, 5, 1)], STAMP) == []
    assert files(tmp_path) == set()
