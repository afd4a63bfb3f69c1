"""Arithmetic with IEEE semantics under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def safe_div_sql(num: str, den: str) -> str:
    """SQL text of :func:`safe_div` for two SQL operands."""
    n, d = f"CAST(({num}) AS DOUBLE)", f"CAST(({den}) AS DOUBLE)"
    return (f"(CASE WHEN {n} IS NULL OR {d} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN {d} <> 0 THEN {n} / NULLIF({d}, 0) "
            f"WHEN {n} = 0 OR isnan({n}) THEN CAST('NaN' AS DOUBLE) "
            f"WHEN {n} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"ELSE CAST('-Infinity' AS DOUBLE) END)")


def safe_div(num, den) -> Column:
    """Double division that never raises.

    ``den != 0`` gives ``num / den``; a zero denominator gives NaN for a zero
    (or NaN) numerator and +/-Infinity by the numerator's sign otherwise.
    NULL in, NULL out.  This is what a warehouse with IEEE doubles returns,
    and what the guards downstream (``isnan`` tests, caps) expect.
    Column names (str) build one SQL expression; Columns use the Column API.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(safe_div_sql(f"`{num}`", f"`{den}`"))
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(d != 0, n / F.when(d != 0, d))
            .when((n == 0) | F.isnan(n), F.lit(float("nan")))
            .when(n > 0, F.lit(float("inf")))
            .otherwise(F.lit(float("-inf"))))
