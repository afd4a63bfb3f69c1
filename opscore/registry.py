"""Registered queries: one callable per SURVEY section 2 key.

Each entry takes the logical tables (``DriverTables``) and returns a
DataFrame; ``queries()`` wraps them as ``(spark, sf_dir) -> DataFrame`` with
the shared output normalisation.  ``PARAMS`` holds the fixed arguments the
oracle SQL uses too (FIXTURES.md section B).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle.normalize import normalize_df
from .sources.driver_tables import DriverTables

PARAMS = {
    "route_as_of": _dt.date(2001, 8, 1),
    "route_days": 365,
    "dash_start": _dt.datetime(2024, 1, 1),
    "dash_end": _dt.datetime(2024, 1, 31),
    "dash_now": _dt.datetime(2024, 1, 20, 12, 0, 0),
    "dash_last_n": 500,
    "start_date": _dt.date(2000, 1, 1),
    "shift_from": _dt.date(2000, 7, 1),
    "as_of_ts": _dt.datetime(2024, 1, 1, 6, 0, 0),
}

Builder = Callable[[DriverTables], DataFrame]
_REGISTRY: dict[str, Builder] = {}


def register(key: str):
    def deco(fn: Builder) -> Builder:
        if key in _REGISTRY:
            raise KeyError(f"duplicate key {key}")
        _REGISTRY[key] = fn
        return fn
    return deco


def builders() -> dict[str, Builder]:
    from . import catalog  # noqa: F401  (registers the keys)
    return dict(_REGISTRY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn: Builder):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize_df(fn(DriverTables(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(fn) for k, fn in builders().items()}


def oracle_sql() -> dict[str, str]:
    from .oracle.normalize import normalize_sql
    from .oracle.spec import SPEC
    from .oracle.sql import ORACLE
    from .oracle.views import with_views
    return {k: normalize_sql(with_views(body), SPEC[k]) for k, body in ORACLE.items()
            if k in SPEC}
