"""Every registered key against its DuckDB oracle (small scale factor)."""

import math

import duckdb
import pytest

from support import SF_ORACLE

TABLES = ("region nation customer supplier part orders lineitem events").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 4) + 0.0)
    return "NULL" if v is None else repr(v)


def _keys():
    from opscore import registry
    return sorted(registry.builders())


@pytest.fixture(scope="module")
def registry_maps():
    from opscore import registry
    return registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("key", _keys())
def test_key_matches_oracle(spark, registry_maps, key):
    qs, oracle = registry_maps
    df = qs[key](spark, SF_ORACLE)
    got = df.collect()
    assert key in oracle, f"{key} has no oracle SQL"
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    rel = con.sql(oracle[key])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(got) == len(want)
    assert sorted(tuple(map(_norm, r)) for r in got) == sorted(tuple(map(_norm, r)) for r in want)


def test_spec_matches_spark_schemas(spark, registry_maps):
    from opscore.oracle.normalize import kind_of
    from opscore.oracle.spec import SPEC
    qs, _ = registry_maps
    for key, fn in qs.items():
        df = fn(spark, SF_ORACLE)
        assert SPEC[key] == [(f.name, kind_of(f.dataType)) for f in df.schema.fields], key


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["iata_origem", "iata_destino", "metasearch_count", "financial_count",
                          "ultimo_fk_search_id", "ultimo_created_at", "metasearch_created_at",
                          "source"]
    assert df.count() >= 0
    from opscore import registry
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("key", ["route_demand", "search_dashboard", "csat_monthly"])
def test_results_do_not_depend_on_session_time_zone(spark, registry_maps, key):
    qs, _ = registry_maps
    before = sorted(map(tuple, qs[key](spark, SF_ORACLE).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        after = sorted(map(tuple, qs[key](spark, SF_ORACLE).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after


@pytest.mark.parametrize("key", ["scorecard_daily", "scorecard_final"])
def test_scorecard_with_later_start_matches_oracle(spark, key):
    """A reporting start inside the data (so the start-date pruning of the
    daily and monthly sides really cuts rows) still matches the oracle."""
    from opscore.oracle.normalize import normalize_df, normalize_sql
    from opscore.oracle.spec import SPEC
    from opscore.oracle.sql import ORACLE
    from opscore.oracle.views import with_views
    from opscore.plans.scorecard import Scorecard
    from opscore.registry import PARAMS as P
    from opscore.sources import DriverTables
    start, shift = "2001-03-01", "2001-05-01"
    sc = Scorecard(DriverTables(spark, SF_ORACLE), start, shift, P["as_of_ts"])
    df = normalize_df(getattr(sc, key))
    body = ORACLE[key].replace(f"DATE '{P['start_date']:%Y-%m-%d}'", f"DATE '{start}'") \
                      .replace(f"DATE '{P['shift_from']:%Y-%m-%d}'", f"DATE '{shift}'")
    sql = normalize_sql(with_views(body), SPEC[key])
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    rel = con.sql(sql)
    idx = [rel.columns.index(c) for c in df.columns]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    got = df.collect()
    assert len(got) > 0 and len(got) == len(want)
    assert sorted(tuple(map(_norm, r)) for r in got) == sorted(tuple(map(_norm, r)) for r in want)
