"""Hand-made edge rows for joins, windows and the finished plans."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from opscore.operators import employee_day_spine, partition_count, ranked, union_null_padded
from opscore.plans.refunds import refund_ledger
from opscore.plans.route_demand import route_demand
from opscore.plans.scorecard import Scorecard
from opscore.sources.contracts import CONTRACTS

D = dt.date
TS = dt.datetime


def tbl(spark, name, rows):
    return spark.createDataFrame(rows, CONTRACTS[name])


def _roster_row(k, month, funcao="E-MAIL", start="08:00:00", end="17:00:00"):
    return (k, month, funcao, "Relacionamento Primário", start, end, "PRIMARIO", "individual",
            1, "S1", 2, "C2", 3, "G3")


# ------------------------------------------------------------------ refunds
def _ledger_tables(spark, logs, items, bank_active=True):
    flights = tbl(spark, "cancelled_flights", [
        (1, 100, 50.0, 11, None, 1, TS(2024, 1, 1)),
        (2, 200, 60.0, None, 22, 1, TS(2024, 1, 2))])
    canc = tbl(spark, "cancellations", [(1, 1, "ana"), (2, 2, "bia")])
    bank = tbl(spark, "refund_bank_data", [
        (1, 7, "0001", "123", 1, "Holder", "000", bank_active)])
    banks = tbl(spark, "banks", [(7, "Banco Sete")])
    statuses = tbl(spark, "flight_statuses", [(1, "open"), (2, "done")])
    reasons = tbl(spark, "cancel_reasons", [(1, "weather")])
    return dict(flights=flights, cancellations=canc, bank_data=bank, banks=banks,
                logs=tbl(spark, "flight_logs", logs), statuses=statuses, reasons=reasons,
                items=tbl(spark, "refund_items", items))


def test_latest_log_tie_takes_higher_id(spark):
    logs = [(10, 1, 1, TS(2024, 2, 1)), (11, 1, 2, TS(2024, 2, 1)), (12, 2, 1, TS(2024, 1, 5))]
    out = refund_ledger(**_ledger_tables(spark, logs, [(1, 5.0), (1, 7.0)])).collect()
    by_id = {r.ID: r for r in out}
    assert by_id[100].STATUSOR == "done"          # log 11 beats log 10 on the same time
    assert by_id[100].VALORESTORNO == 12.0
    assert by_id[200].VALORESTORNO is None          # no items -> NULL, row kept
    assert by_id[100].TIPOEDEESTORNO == "Convencional"
    assert by_id[200].TIPOEDEESTORNO == "Outros"
    assert by_id[100].BANCO == "Banco Sete" and by_id[100].CORRENTEPOUPANCA == "Corrente"


def test_flight_without_logs_is_dropped_and_inactive_bank_is_null(spark):
    logs = [(10, 1, 1, TS(2024, 2, 1))]
    out = refund_ledger(**_ledger_tables(spark, logs, [], bank_active=False)).collect()
    assert [r.ID for r in out] == [100]
    assert out[0].BANCO is None and out[0].NUMERO is None
    assert out[0].CORRENTEPOUPANCA == "Poupança"


# ------------------------------------------------------------------ route demand
def test_route_demand_duplicate_tracking_and_other_source(spark):
    t0 = TS(2024, 1, 10)
    searches = tbl(spark, "searches", [
        (1, "GRU", "REC", "F", "ExternalSearch", t0),
        (2, "GRU", "REC", "F", "ExternalSearch", t0),
        (3, "GIG", "SSA", "X", "ExternalSearch", t0),
        (4, "GIG", "SSA", "X", "Site", t0)])
    orders = tbl(spark, "orders_booked", [(1, 1, t0, 56), (3, 3, t0, 60), (4, 4, t0, 60)])
    tracking = tbl(spark, "order_tracking", [
        (1, t0, "F"), (1, t0, "F"), (1, t0, "F"),     # one order, three tracking rows
        (3, t0, "X"), (4, TS(2024, 1, 11), "Y")])      # newest GIG-SSA sale came from Y
    out = {(r.iata_origem, r.source): r
           for r in route_demand(searches, orders, tracking, D(2024, 1, 20), 30).collect()}
    assert out[("GRU", "F")].financial_count == 3
    assert out[("GRU", "F")].metasearch_count == 2
    assert out[("GIG", "X")].financial_count == 0
    assert out[("GIG", "X")].ultimo_fk_search_id is None


# ------------------------------------------------------------------ scorecard
def _production(spark, prod_qty, absence):
    month = D(2024, 3, 1)
    roster = tbl(spark, "roster", [_roster_row(7, month)])
    res = tbl(spark, "resolutions", [(D(2024, 3, 5), 7, 1, prod_qty, "q", None)])
    ab = tbl(spark, "absences", [(D(2024, 3, 5), 7, "N", "P", *absence)])
    sc = Scorecard({"roster": roster, "resolutions": res, "absences": ab}, "2024-01-01",
                   "2024-07-01", TS(2024, 4, 1))
    return [r.producao for r in sc.production_with_absence.collect()]


def test_absence_overlay(spark):
    assert _production(spark, 8.0, (1, 0, 0)) == [0.0]       # unjustified beats production
    assert _production(spark, 8.0, (0, 1, 0)) == [None]      # justified: NULL ranks as 0.1
    assert _production(spark, 8.0, (0, 0, 0)) == [None]      # all-zero absence row
    assert _production(spark, 0.0, (0, 1, 0)) == [0.0]       # 0 < 0.1


def test_cycle_ratio_nan_counts_zero(spark):
    cp = tbl(spark, "cycle_positions", [
        (D(2024, 3, 1), "Atendimento Primário", "Aéreo", 0, 2, 2),
        (D(2024, 3, 2), "Atendimento Primário", "Aéreo", 3, 5, 1)])
    sc = Scorecard({"cycle_positions": cp}, "2024-01-01", "2024-07-01", TS(2024, 4, 1))
    r = sc.cycle_rate_monthly.first()
    assert r.area == "Relacionamento Primário" and r.valor_ciclo_c == 0.375


def test_two_loss_days_fan_out(spark):
    month = D(2024, 3, 1)
    tables = {
        "roster": tbl(spark, "roster", [_roster_row(7, month)]),
        "contact_calendar": tbl(spark, "contact_calendar", [(TS(2024, 3, 4),)]),
        "losses": tbl(spark, "losses", [(D(2024, 3, 5), 7, "100"), (D(2024, 3, 9), 7, "2000")]),
    }
    sc = Scorecard(tables, "2024-01-01", "2024-07-01", TS(2024, 4, 1))
    d = sc.employee_days.withColumn("ym", F.trunc("dia", "month"))
    lo = sc.loss_penalty_daily.select(F.trunc("data_ref", "month").alias("ym"), "matricula",
                                      "p_prejuizo")
    rows = d.join(lo, ["matricula", "ym"], "left").collect()
    assert sorted(r.p_prejuizo for r in rows) == [-15, -5]


def test_shift_collision_collapses(spark):
    from opscore.functions import fiscal_shift
    df = spark.createDataFrame([(D(2022, 7, 26), 1.0), (D(2022, 8, 1), 1.0)], "d date, v double")
    out = df.select(fiscal_shift("d", "2022-07-01").alias("d"), "v").distinct().collect()
    assert len(out) == 1


def test_employee_day_spine_is_distinct(spark):
    month = D(2024, 3, 1)
    roster = tbl(spark, "roster", [_roster_row(7, month), _roster_row(7, month),
                                   _roster_row(8, month)])
    cal = tbl(spark, "contact_calendar", [(TS(2024, 3, 4, 10),), (TS(2024, 3, 4, 11),),
                                          (TS(2024, 3, 6),), (TS(2024, 4, 1),)])
    rows = employee_day_spine(cal, roster).collect()
    assert sorted((r.matricula, r.dia) for r in rows) == [
        (7, D(2024, 3, 4)), (7, D(2024, 3, 6)), (8, D(2024, 3, 4)), (8, D(2024, 3, 6))]


# ------------------------------------------------------------------ windows
def test_ranked_matches_row_number_with_hot_key(spark):
    rows = [(1 if i % 3 else i, i % 17, f"s{i % 5}") for i in range(3000)]  # key 1 is hot
    df = spark.createDataFrame(rows, "k long, t long, s string")
    order = [F.col("t").desc(), F.col("s").desc()]
    got = ranked(df, ["k"], order, alias="rn", bucket=F.floor(F.col("t") / 4))
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    key = ["k", "t", "s", "rn"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(
        map(tuple, want.select(*key).collect()))


def test_partition_count_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v long")
    got = sorted((r.k or "", r.n) for r in partition_count(df, ["k"], "v", "n").collect())
    assert got == [("", 2), ("", 2), ("a", 1)]


def test_union_null_padded_types(spark):
    full = spark.createDataFrame([(1, 2.0, "x")], "a long, b double, c string")
    part = spark.createDataFrame([(1,)], "a int")
    out = union_null_padded(full, part)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "string"]
    assert out.count() == 2


def test_ranked_by_bucket_with_extra_columns_and_a_hot_key(spark):
    """200,000 rows, a third of one key, a column outside keys and order: same as the plain
    window, whatever Spark does with exchanges and adaptive plans."""
    df = spark.range(200_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k",
        "timestamp_seconds((id * 7919) % 2000000) AS t", "id", "concat('x', id % 13) AS extra")
    order = [F.col("t").desc(), F.col("id").asc()]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    for reuse, aqe in (("true", "true"), ("false", "true"), ("false", "false")):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            got = ranked(df, ["k"], order, bucket=F.to_date("t"))
            assert got.columns == want.columns
            assert got.count() == 200_000
            assert got.exceptAll(want).count() == 0
        finally:
            spark.conf.set("spark.sql.exchange.reuse", "true")
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ranked_puts_null_keys_and_buckets_last(spark):
    df = spark.createDataFrame([(None, TS(2024, 1, 2), 1), (None, None, 2), (None, TS(2024, 1, 1), 3),
                                ("a", None, 4)], "k string, t timestamp_ntz, id int")
    got = ranked(df, ["k"], [F.col("t").desc_nulls_last()], bucket=F.to_date("t"))
    assert sorted((r.id, r.rn) for r in got.collect()) == [(1, 1), (2, 3), (3, 2), (4, 1)]


def test_oversized_target_sheet_still_joins(spark):
    """Targets beyond the broadcast threshold: a shuffle join with the same rows."""
    from opscore.operators.joins import month_target_join, targets_for
    from opscore.functions.calendar import month_key
    days = spark.range(300).selectExpr("date_add(date'2024-01-01', CAST(id % 90 AS INT)) AS dia", "id")
    sheet = spark.range(3000).selectExpr(
        "'X' AS indicador", "'individual' AS tipo", "'PRIMARIO' AS origem",
        "add_months(date'2024-01-01', CAST(id % 3 AS INT)) AS ref", "CAST(id AS DOUBLE) AS m_ouro")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = {}
    for limit in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            j = month_target_join(days.withColumn("ym", month_key("dia")), targets_for(sheet, "x"))
            plan = j._jdf.queryExecution().executedPlan().toString()
            rows[limit] = j.agg(F.count("*"), F.sum("m_ouro")).first()
            assert limit != "-1" or "SortMergeJoin" in plan
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows[old] == rows["-1"] and rows[old][0] == 300_000


def test_nan_is_above_nothing(spark):
    from opscore.functions import Bands, band_score
    from opscore.functions.labels import percent_guard
    from support import BANDS_DOWN
    df = spark.createDataFrame([(float("nan"),), (2.0,), (0.5,)], "v double")
    assert [str(r[0]) for r in df.select(percent_guard("v")).collect()] == ["nan", "0.0", "0.5"]
    wide = df.select("v", *[F.lit(v).alias(k) for k, v in BANDS_DOWN.items()])
    got = [r[0] for r in wide.select(band_score("v", Bands(), direction="down")).collect()]
    assert got[0] == BANDS_DOWN["p_2"] and got[1] == 0.0


def test_materialised_daily_gives_the_same_final_rows(spark, tmp_path):
    from support import SF_SMALL
    from opscore.plans.scorecard import Scorecard
    from opscore.registry import PARAMS as P
    from opscore.sources import DriverTables
    sc = Scorecard(DriverTables(spark, SF_SMALL), "2001-03-01", "2001-05-01", P["as_of_ts"])
    lazy = sc.scorecard_final
    handle = sc.materialise_daily(str(tmp_path))
    written = sc.scorecard_final
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    digits = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert same(digits(lazy), digits(written))
    handle.drop()
    assert list(tmp_path.iterdir()) == []


def test_production_with_absence_function(spark):
    from opscore.plans.scorecard import production_with_absence
    month = D(2024, 3, 1)
    roster = tbl(spark, "roster", [_roster_row(7, month)])
    res = tbl(spark, "resolutions", [(D(2024, 3, 5), 7, 1, 8.0, "q", None)])
    ab = tbl(spark, "absences", [(D(2024, 3, 5), 7, "N", "P", 1, 0, 0)])
    assert [r.producao for r in production_with_absence(res, roster, ab).collect()] == [0.0]
