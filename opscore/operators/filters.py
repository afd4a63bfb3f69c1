"""Row filters.  Literal bounds are computed from arguments, so
the comparison reaches the Parquet scan as a pushed filter."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def as_timestamp(t) -> _dt.datetime:
    if isinstance(t, _dt.datetime):
        return t
    if isinstance(t, _dt.date):
        return _dt.datetime(t.year, t.month, t.day)
    return _dt.datetime.fromisoformat(str(t))


def ts_lit(t) -> Column:
    """A wall-clock (TIMESTAMP_NTZ) literal, built from text so neither the
    session nor the Python process time zone can shift it."""
    return F.lit(as_timestamp(t).isoformat(sep=" ")).cast("timestamp_ntz")


def rolling_days_filter(df: DataFrame, col: str, as_of, days: int) -> DataFrame:
    """Rows with ``col >= as_of - days`` (midnight), ``as_of`` being "today"."""
    cutoff = as_date(as_of) - _dt.timedelta(days=days)
    return df.filter(F.col(col) >= ts_lit(cutoff))


def date_floor_filter(df: DataFrame, col: str, start) -> DataFrame:
    """Rows whose calendar day is on or after ``start``."""
    return df.filter(F.to_date(F.col(col)) >= F.lit(as_date(start)))


def future_filter(df: DataFrame, col: str, now) -> DataFrame:
    """Rows at or after the instant ``now`` (dates compare as midnight)."""
    return df.filter(F.col(col).cast("timestamp_ntz") >= ts_lit(now))


def between_filter(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range, bounds as wall-clock timestamps."""
    return df.filter(F.col(col).between(ts_lit(lo), ts_lit(hi)))


def status_in_filter(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def not_in_filter(df: DataFrame, col: str, values) -> DataFrame:
    """SQL NOT IN: a NULL value is unknown and therefore dropped."""
    return df.filter(~F.col(col).isin(*values))


def normalised(col, case: str = "lower", trim: bool = True) -> Column:
    """Case-folded (and optionally space-trimmed) text for comparisons."""
    c = F.col(col) if isinstance(col, str) else col
    if trim:
        c = F.trim(c)
    if case == "lower":
        return F.lower(c)
    if case == "upper":
        return F.upper(c)
    if case == "exact":
        return c
    raise ValueError(case)


def normalised_match(col, value: str, case: str = "lower", trim: bool = True) -> Column:
    return normalised(col, case, trim) == F.lit(value)


def trailing_id_window(df: DataFrame, id_col: str, ref: DataFrame, ref_id_col: str,
                       n: int) -> DataFrame:
    """``id >= max(ref.id) - n``: the max is an uncorrelated scalar subquery,
    evaluated once for the whole job."""
    top = ref.select(F.max(ref_id_col)).scalar()
    return df.filter(F.col(id_col) >= top - F.lit(n))
