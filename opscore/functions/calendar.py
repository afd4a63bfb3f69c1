"""Calendar helpers: month keys, the fiscal-period shift and cut-off months."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def month_key(d) -> Column:
    """First day of the month: one equi-join key instead of month()=.. AND year()=.."""
    return F.trunc(F.to_date(_col(d)), "month")


def date_parts(d) -> dict[str, Column]:
    """year, month, day (int) and the calendar date of a date or timestamp."""
    c = _col(d)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
            "date": F.to_date(c)}


def fiscal_shift(d, shift_from="2022-07-01", first_day: int = 26) -> Column:
    """Move the last days of a month into the next fiscal month.

    From ``shift_from`` on, days ``first_day``..31 become days 1..6 of the
    next month (26 Dec -> 1 Jan of the next year).  Earlier dates and other
    days are returned unchanged.
    """
    day = F.to_date(_col(d))
    dom = F.dayofmonth(day)
    shifted = F.date_add(F.add_months(F.trunc(day, "month"), 1), dom - first_day)
    return F.when((day >= _date_lit(shift_from)) & (dom >= first_day), shifted).otherwise(day)


def cutoff_month(d, first_day: int = 26) -> Column:
    """Date whose year/month is the reporting month: day >= first_day counts
    for the next month (calendar clamp: 31 Jan -> 28/29 Feb)."""
    day = F.to_date(_col(d))
    return F.when(F.dayofmonth(day) >= first_day, F.add_months(day, 1)).otherwise(day)
