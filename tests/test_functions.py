"""Edge rows of FIXTURES.md section C for the Column-level functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import BANDS_DOWN, BANDS_UP, make_df
from opscore.functions import (account_kind, band_score, cutoff_month, fiscal_shift,
                               imputed_band_score, interaction_discount, percent_guard,
                               queue_weight, recontact_ratio, refund_kind, safe_div,
                               shift_class, step_penalty)
from opscore.functions.scoring import Bands, LEVELS

BAND_DDL = ", ".join(f"{k}_{lv} double" for k in ("m", "p") for lv in LEVELS)


def _scores(spark, bands, values, **kw):
    rows = [(v, *[bands[f"{k}_{lv}"] for k in ("m", "p") for lv in LEVELS]) for v in values]
    df = make_df(spark, rows, f"v double, {BAND_DDL}")
    out = df.select(band_score("v", Bands(), **kw).alias("s")).collect()
    return [None if r.s is None else round(r.s, 9) for r in out]


def test_band_up_capped(spark):
    assert _scores(spark, BANDS_UP, [0.6, 0.75, 0.4, 1.2, None]) == [10, 25, -10, 50, 50]


def test_band_up_extrapolated(spark):
    assert _scores(spark, BANDS_UP, [1.0, 1.2, None, 0.75], above="extrapolate") == [
        None, 60, None, 25]


def test_band_down(spark):
    assert _scores(spark, BANDS_DOWN, [0.6, 0.5, 0.35, 0.01], direction="down") == [0, 0, 15, 50]


def test_band_null_policy(spark):
    assert _scores(spark, BANDS_UP, [None], null_policy="null") == [None]


def test_band_hits_points_at_thresholds(spark):
    ms = [BANDS_UP[f"m_{lv}"] for lv in LEVELS]
    ps = [BANDS_UP[f"p_{lv}"] for lv in LEVELS]
    assert _scores(spark, BANDS_UP, ms) == ps


def test_imputed(spark):
    rows = [(None, *[BANDS_UP[f"{k}_{lv}"] for k in ("m", "p") for lv in LEVELS])]
    df = make_df(spark, rows, f"v double, {BAND_DDL}")
    v, s = imputed_band_score("v", Bands())
    r = df.select(v.alias("v"), s.alias("s")).first()
    assert (r.v, r.s) == (0.6, 10.0)


def test_display_guard_and_score_use_raw_value(spark):
    rows = [(1.3, *[BANDS_UP[f"{k}_{lv}"] for k in ("m", "p") for lv in LEVELS])]
    df = make_df(spark, rows, f"v double, {BAND_DDL}")
    r = df.select(percent_guard("v").alias("shown"),
                  band_score("v", Bands()).alias("s")).first()
    assert (r.shown, r.s) == (0.0, 50.0)


def test_fiscal_shift_edges(spark):
    days = [dt.date(2022, 6, 30), dt.date(2022, 7, 25), dt.date(2022, 7, 26),
            dt.date(2022, 12, 31), dt.date(2023, 1, 31)]
    df = make_df(spark, [(d,) for d in days], "d date")
    got = [r.s for r in df.select(fiscal_shift("d", "2022-07-01").alias("s")).collect()]
    assert got == [dt.date(2022, 6, 30), dt.date(2022, 7, 25), dt.date(2022, 8, 1),
                   dt.date(2023, 1, 6), dt.date(2023, 2, 6)]


def _verbose_shift(d: dt.date, start: dt.date) -> dt.date:
    """The period shift as the warehouse spells it: a text date rebuilt from
    year(d [+1 year in December]), month(d + 1 month) and day - 25."""
    if d < start or d.day < 26:
        return d
    nxt_month = d.month % 12 + 1
    year = d.year + 1 if d.month == 12 else d.year
    return dt.date.fromisoformat(f"{year:04d}-{nxt_month:02d}-{d.day - 25:02d}")


def test_fiscal_shift_equals_verbose_case_on_every_day(spark):
    start = dt.date(2022, 7, 1)
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(6 * 366)]
    df = make_df(spark, [(d,) for d in days], "d date")
    got = {r.d: r.s for r in df.select("d", fiscal_shift("d", start).alias("s")).collect()}
    assert all(got[d] == _verbose_shift(d, start) for d in days)


def test_cutoff_month(spark):
    days = [dt.date(2021, 1, 25), dt.date(2021, 1, 26), dt.date(2021, 12, 31)]
    df = make_df(spark, [(d,) for d in days], "d date")
    c = cutoff_month("d")
    got = [(r.y, r.m) for r in df.select(F.year(c).alias("y"), F.month(c).alias("m")).collect()]
    assert got == [(2021, 1), (2021, 2), (2022, 1)]


def test_queue_weight_and_interactions(spark):
    df = make_df(spark, [("Remarcação ", 1), ("Remarcação", 2), (None, 3), ("x", None)],
                 "fila string, n int")
    got = [(r.w, r.d) for r in df.select(queue_weight("fila").alias("w"),
                                         interaction_discount("n").alias("d")).collect()]
    assert got == [(1.0, 1.0), (0.7, 0.5), (0.7, 0.1), (0.7, 0.1)]


def test_shift_class(spark):
    df = make_df(spark, [("01:00:00", "07:00:00"), ("06:00:00", "15:00:00"),
                         ("06:00:00", "14:00:00")], "s string, e string")
    got = [r.c for r in df.select(shift_class("s", "e").alias("c")).collect()]
    assert got == ["madrugada", "comercial", "dia"]


def test_recontact_ratio(spark):
    df = make_df(spark, [(3.0, None), (3.0, 2.0), (1.0, 4.0), (0.0, 0.0), (None, 4.0)],
                 "rec double, res double")
    got = [r.x for r in df.select(recontact_ratio("rec", "res").alias("x")).collect()]
    assert got == [1.0, 1.0, 0.25, 1.0, None]


def test_recontact_null_scores_top(spark):
    assert _scores(spark, BANDS_DOWN, [None], direction="down") == [50]


def test_step_penalty(spark):
    df = make_df(spark, [(1000.4,), (1000.5,), (10000.0,), (10001.0,), (0.0,), (None,)],
                 "x double")
    got = [r.p for r in df.select(step_penalty(F.col("x")).alias("p")).collect()]
    assert got == [-5, -10, -30, -50, -5, None]


def test_safe_div(spark):
    df = make_df(spark, [(0.0, 0.0), (3.0, 0.0), (-3.0, 0.0), (3.0, 4.0), (None, 1.0)],
                 "n double, d double")
    got = [r.q for r in df.select(safe_div(F.col("n"), F.col("d")).alias("q")).collect()]
    assert got[0] != got[0]  # NaN
    assert got[1:] == [float("inf"), float("-inf"), 0.75, None]


def test_refund_and_account_kind(spark):
    df = make_df(spark, [(1, None, 1), (None, 2, 2), (1, 2, None), (None, None, 1)],
                 "a long, b long, t int")
    got = [(r.k, r.acc) for r in df.select(refund_kind("a", "b").alias("k"),
                                           account_kind("t").alias("acc")).collect()]
    assert got == [("Convencional", "Corrente"), ("Outros", "Poupança"),
                   ("Mesclado", "Poupança"), ("Mesclado", "Corrente")]


@pytest.mark.parametrize("digits", [2])
def test_round_is_decimal_half_up(spark, digits):
    df = make_df(spark, [(0.285,), (0.125,), (2.5,)], "x double")
    got = [r.r for r in df.select(F.round("x", digits).alias("r")).collect()]
    assert got == [0.29, 0.13, 2.5]


def test_band_continuous_at_thresholds(spark):
    """Just below each threshold the score approaches that threshold's points."""
    ms = [BANDS_UP[f"m_{lv}"] for lv in LEVELS][1:]
    ps = [BANDS_UP[f"p_{lv}"] for lv in LEVELS][1:]
    got = _scores(spark, BANDS_UP, [m - 1e-9 for m in ms])
    assert all(abs(g - p) < 1e-5 for g, p in zip(got, ps))
    dm = [BANDS_DOWN[f"m_{lv}"] for lv in LEVELS][1:]
    dp = [BANDS_DOWN[f"p_{lv}"] for lv in LEVELS][1:]
    got = _scores(spark, BANDS_DOWN, [m + 1e-9 for m in dm], direction="down")
    assert all(abs(g - p) < 1e-5 for g, p in zip(got, dp))
