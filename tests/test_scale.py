"""Hot keys, exact sums and narrow plans of the reworked operators."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# ---------------------------------------------------------------- split left join
def hot_tables(spark, hot=9_000):
    left = [(1, i) for i in range(30)] + [(k, 0) for k in range(2, 60)] + [(None, 7), (999, 8)]
    right = [(1, f"r{i}") for i in range(hot)] + [(k, f"x{k}") for k in range(2, 50)] + [(None, "none"), (500, "alone")]
    return (spark.createDataFrame(left, "k int, a int").repartition(5),
            spark.createDataFrame(right, "k int, b string").repartition(5))


def test_split_left_join_equals_a_left_join(spark):
    from opscore.operators import split_left_join
    left, right = hot_tables(spark)
    got = split_left_join(left, right, ["k"], least_rows=100)
    assert got.columns == ["k", "a", "b"]
    assert rows(got) == rows(left.join(right, "k", "left"))


def test_a_hot_right_key_is_joined_in_several_tasks(spark):
    from opscore.operators import split_left_join
    left, right = hot_tables(spark)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sizes = {}
        for name, df in (("plain", left.join(right, "k", "left")), ("split", split_left_join(left, right, ["k"], least_rows=100))):
            sizes[name] = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sizes["plain"][-1] >= 30 * 9_000
    assert sizes["split"][-1] < 0.2 * sum(sizes["split"])


def test_no_key_is_heavy_in_small_or_even_tables(spark):
    from opscore.operators import heavy_keys
    left, right = hot_tables(spark)
    assert heavy_keys(right, ["k"]).collect() == []
    assert [(r["k"], r["_parts"] > 1) for r in heavy_keys(right, ["k"], 100).collect()] == [(1, True)]
    assert heavy_keys(right.limit(0), ["k"], 1).collect() == []


def test_hot_cancellation_in_the_refund_ledger(spark):
    """A third of all bank rows on one cancellation: the ledger's rows are those of the plain join."""
    from opscore.operators import joins
    from opscore.sources import DriverTables
    t = DriverTables(spark, SF_SMALL)
    base = t["cancellations"].select(F.col("id").alias("cancellation_key"), "created_name")
    bank = t["refund_bank_data"].withColumnRenamed("cancellation_id", "cancellation_key")
    hot = bank.limit(1).crossJoin(spark.range(600)).withColumn("agency", F.col("id").cast("string")).drop("id")
    bank = bank.unionByName(hot)
    assert rows(joins.split_left_join(base, bank, ["cancellation_key"], 50)) == rows(base.join(bank, "cancellation_key", "left"))


# ---------------------------------------------------------------- rank
def plain_rank(tracking):
    from pyspark.sql import Window
    w = Window.partitionBy("fk_order_id").orderBy(F.desc_nulls_last("created_at"), F.desc_nulls_last("source"))
    return tracking.withColumn("rn", F.row_number().over(w))


def tracked(spark):
    day = dt.datetime(2024, 1, 10)
    out = [(1, day + dt.timedelta(seconds=i % 2_500), "FOP"[i % 3]) for i in range(6_000)]
    out += [(1, day + dt.timedelta(days=-1), "F")] * 800 + [(k, day + dt.timedelta(hours=k % 7), None) for k in range(2, 90)]
    out += [(None, day, "F"), (None, day, "O"), (2, None, "F")]
    return spark.createDataFrame(out, "fk_order_id long, created_at timestamp_ntz, source string").repartition(6)


def test_rank_of_a_hot_day_equals_row_number(spark):
    from opscore.plans.route_demand import tracking_rank
    t = tracked(spark)
    want = plain_rank(t.filter("created_at IS NOT NULL"))
    assert rows(tracking_rank(t, "2024-01-20", 30, least_rows=200)) == rows(want.select("fk_order_id", "created_at", "source", "rn"))
    assert rows(tracking_rank(t, "2024-01-20", 30)) == rows(want.select("fk_order_id", "created_at", "source", "rn"))


def test_a_hot_day_is_cut_into_bounded_windows(spark):
    from opscore.operators.windows import _cuts
    t = tracked(spark).distinct().withColumn("_bucket", F.to_date("created_at")).withColumn(
        "_value", F.unix_micros(F.col("created_at").cast("timestamp")))
    cuts = _cuts(t, ["fk_order_id", "_bucket"], "_value", 200).collect()
    assert [r["fk_order_id"] for r in cuts] == [1]
    values = sorted(r["_value"] for r in t.filter("fk_order_id = 1 AND day(created_at) = 10").collect())
    sizes = Counter(sum(c < v for c in cuts[0]["_cuts"]) for v in values)
    assert len(sizes) > 10 and max(sizes.values()) < 2 * 200


# ---------------------------------------------------------------- scorecard
def scorecard(spark, tables=None, **kw):
    from opscore.plans.scorecard import Scorecard
    from opscore.sources import DriverTables
    return Scorecard(tables or DriverTables(spark, SF_SMALL), "2001-03-01", "2001-05-01", "2024-01-01 06:00:00", **kw)


def plan_of(spark, df):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.mark.parametrize("name,most", [("scorecard_daily", 3), ("recontact_monthly", 2), ("scorecard_final", 5)])
def test_how_often_the_largest_table_is_read(spark, name, most):
    plan = plan_of(spark, getattr(scorecard(spark), name))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_shipdate" in ln]
    assert 0 < len(scans) <= most


def test_monthly_recontacts_need_no_team_result(spark):
    plan = plan_of(spark, scorecard(spark).recontact_monthly)
    for column in ("valor_ciclo_c", "valor_conhec_c", "nota_dto", "nota_conhecimento"):
        assert column not in plan


def both_ways(spark, tables):
    return [rows(scorecard(spark, tables, one_team_row=one).recontact_monthly.select(
        "ano_ref", "mes_ref", "matricula", F.round("resolvidos_rec", 6), F.round("recorrencia", 6))) for one in (True, False)]


def test_monthly_recontacts_equal_those_of_the_card(spark):
    light, card = both_ways(spark, None)
    assert light == card and light


def test_several_team_rows_of_a_month_are_noticed(spark):
    from opscore.sources import DriverTables
    t = DriverTables(spark, SF_SMALL)
    names = ["roster", "targets", "resolutions", "recontacts", "absences", "contact_calendar", "cycle_positions",
             "monthly_grades", "collective_extras", "losses", "csat_answers"]
    tables = {n: t[n] for n in names}
    tables["collective_extras"] = tables["collective_extras"].unionAll(tables["collective_extras"])
    light, card = both_ways(spark, tables)  # equal rows collapse
    assert light == card
    tables["collective_extras"] = tables["collective_extras"].unionAll(tables["collective_extras"].withColumn("nps", F.lit(1.0)))
    with pytest.raises(Exception, match="several team rows"):
        scorecard(spark, tables).recontact_monthly.collect()
    assert scorecard(spark, tables, one_team_row=False).recontact_monthly.count() > 0


@pytest.mark.parametrize("name", ["resolution_score_daily", "recontact_daily", "cycle_rate_monthly", "scorecard_daily"])
def test_sums_do_not_depend_on_the_partitioning(spark, name):
    from opscore.sources import DriverTables
    t = DriverTables(spark, SF_SMALL)
    big = ("resolutions", "recontacts", "cycle_positions")
    names = ["roster", "targets", "absences", "contact_calendar", "monthly_grades", "collective_extras", "losses", "csat_answers"]
    seen = []
    for n in (1, 7, 64):
        tables = {k: t[k] for k in names} | {k: t[k].repartition(n) for k in big}
        df = getattr(scorecard(spark, tables), name)
        seen.append(rows(df.select(*[F.col(c).cast("string") if ty == "double" else F.col(c) for c, ty in df.dtypes])))
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_mean_of_hundredths_keeps_infinity(spark):
    from opscore.plans.scorecard import _mean_of_hundredths
    inf = float("inf")
    data = [(1, 0.1), (1, 0.2), (1, None), (2, inf), (2, 0.5), (3, None), (4, inf), (4, -inf)]
    df = spark.createDataFrame(data, "k int, v double").groupBy("k").agg(_mean_of_hundredths(F.col("v")).alias("m"))
    got = {r["k"]: r["m"] for r in df.collect()}
    assert abs(got[1] - 0.15) < 1e-12 and got[2] == inf and got[3] is None and got[4] != got[4]


# ---------------------------------------------------------------- roster joins
def test_month_roster_counts_equal_the_sums_of_the_joined_rows(spark):
    from opscore.operators import month_roster_counts, month_roster_join
    days = spark.createDataFrame(
        [(k, dt.date(2024, m, d), v) for k in (1, 2, 3, None) for m in (1, 2) for d, v in ((3, 1.5), (9, None), (28, 0.25))]
        + [(1, None, 4.0)], "matricula long, dia date, v double")
    roster = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "a")] * 3 + [(1, dt.date(2024, 1, 1), "b"), (2, dt.date(2024, 2, 1), None),
                                               (2, dt.date(2024, 2, 7), None), (None, dt.date(2024, 1, 1), "c"), (3, None, "d")],
        "matricula long, mes_referencia date, area string")
    for how in ("inner", "left"):
        want = (month_roster_join(days, roster, "dia", how=how, roster_cols=["area"])
                .groupBy("matricula", "dia", "area").agg(F.sum("v").alias("v")))
        got = month_roster_counts(days, roster, "dia", ["area"], how=how).select(
            "matricula", "dia", "area", (F.col("v") * F.col("_rows")).alias("v"))
        assert rows(got) == rows(want)


@pytest.mark.parametrize("key", ["union_distinct", "production_score", "production_with_absence", "recontact_daily",
                                 "shift_class_production", "union_null_padded", "worst_production_per_day",
                                 "resolution_score_daily"])
def test_no_task_holds_a_copy_of_the_roster(spark, key):
    """The roster is planned for as small as the suppliers it is expanded from, yet no join broadcasts it."""
    from opscore import registry
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    joins = [ln for ln in plan.splitlines() if "_rk" in ln and "Join" in ln]
    assert joins and all("SortMergeJoin" in ln for ln in joins)


@pytest.mark.parametrize("name", ["scorecard_final", "scorecard_daily", "csat_monthly", "dto_individual", "knowledge_individual"])
def test_the_card_broadcasts_nothing_that_grows_with_the_agents(spark, name):
    """Roster, grades and targets are expanded from one row and planned for as small as that; only what a month
    has a few rows of, and the heavy keys of the losses, may be sent to every task."""
    import re

    from opscore.plans.scorecard import Scorecard
    from opscore.sources import CONTRACTS
    short = {"roster": 2_000, "monthly_grades": 2_000, "targets": 3, "collective_extras": 3}
    tables = {}
    for table, schema in CONTRACTS.items():
        if table in short:
            df = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(short[table]))).alias("n"))
            tables[table] = df.select(*[F.col("n").cast("string").cast(f.dataType).alias(f.name) for f in schema])
        else:
            tables[table] = spark.createDataFrame([], schema)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(spark, getattr(Scorecard(tables, "2001-03-01", "2001-05-01", "2024-01-01 06:00:00"), name))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sent = [re.sub(r"#\d+L?", "", ln.split("BroadcastHashJoin ")[1]) for ln in plan.splitlines() if "BroadcastHashJoin" in ln]
    by_month = [ln for ln in sent if re.match(r"\[_?ym\], \[_?t?ym\], Inner, BuildRight", ln)]
    heavy = [ln for ln in sent if ln.startswith("[matricula, ym], [matricula, ym], LeftOuter, BuildRight")]
    assert by_month and len(heavy) == 2 * (name == "scorecard_final") and len(by_month) + len(heavy) == len(sent), sent
