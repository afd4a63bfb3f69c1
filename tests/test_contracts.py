import datetime as dt

import pytest

from opscore.sources.contracts import CONTRACTS, ContractError, conform


def test_conform_casts_and_orders_columns(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 5, 14, 0), "7", "x", 2.0, 1, None, "extra")],
        "data_resolucao timestamp_ntz, matricula string, fila string, "
        "quantidade_incidentes double, quantidade_interacoes int, atendente string, junk string")
    out = conform(df, "resolutions")
    assert out.columns == [f.name for f in CONTRACTS["resolutions"].fields]
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "date", "bigint", "int", "double", "string", "string"]
    r = out.first()
    assert (r.data_resolucao, r.matricula) == (dt.date(2024, 3, 5), 7)


def test_conform_reports_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ContractError, match="ap"):
        conform(df, "purchase_searches")


def test_every_contract_is_loaded_by_the_driver_tables(spark):
    from opscore.sources import DriverTables
    t = DriverTables(spark, "/root/testdata/sf0.001")
    for name, schema in CONTRACTS.items():
        got = [(f.name, f.dataType) for f in t[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_catalog_tables_feed_the_plans(spark):
    """Tables registered in the catalog under any names run the same plans."""
    from opscore.plans.route_demand import route_demand
    from opscore.registry import PARAMS as P
    from opscore.sources import CatalogTables, DriverTables
    d = DriverTables(spark, "/root/testdata/sf0.001")
    names = {}
    for logical in ("searches", "orders_booked", "order_tracking"):
        view = f"my_{logical}"
        d[logical].createOrReplaceTempView(view)
        names[logical] = view
    c = CatalogTables(spark, names)
    got = route_demand(c["searches"], c["orders_booked"], c["order_tracking"],
                       P["route_as_of"], P["route_days"])
    want = route_demand(d["searches"], d["orders_booked"], d["order_tracking"],
                        P["route_as_of"], P["route_days"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(KeyError):
        CatalogTables(spark, {"not_a_table": "x"})


def test_checked_read_counts_what_does_not_fit(spark):
    from opscore.sources import conform_checked
    rows = [("1", "2024-03-05", "9.5"), ("2", "not a day", "x"), ("2", None, "7"), (None, "2024-03-06", None), ("six", "2024-03-07", "1")]
    df = spark.createDataFrame(rows, "solicitante_matricula string, data_ref string, reembolso_valor_prejuizo string").repartition(3)
    read = conform_checked(df, "losses", keys=["solicitante_matricula"])
    got = {tuple(r) for r in read.rows.collect()}
    assert (dt.date(2024, 3, 5), 1, "9.5") in got and (None, 2, "x") in got and (dt.date(2024, 3, 7), None, "1") in got
    report = read.report()
    assert report.rows == 5
    assert report.nulls == {"data_ref": 1, "solicitante_matricula": 1, "reembolso_valor_prejuizo": 1}
    assert report.unparsable == {"data_ref": 1, "solicitante_matricula": 1, "reembolso_valor_prejuizo": 0}
    assert report.distinct_keys == 2 and report.repeated_keys == 3 and not report.clean


def test_checked_read_is_one_scan_and_equals_conform(spark):
    from opscore.sources import DriverTables, conform_checked
    raw = DriverTables(spark, "/root/testdata/sf0.001")._build_resolutions()
    read = conform_checked(raw, "resolutions")
    plan = read.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "CollectMetrics" in plan
    assert read.rows.exceptAll(conform(raw, "resolutions")).count() == 0
    report = read.report()
    assert report.clean and report.rows == raw.count() and report.distinct_keys is None
    with pytest.raises(ContractError, match="ap"):
        conform_checked(spark.createDataFrame([(1,)], "id long"), "purchase_searches")
