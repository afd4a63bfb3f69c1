"""Output normalisation shared by the Spark side and the oracle side.

Both engines must return identical values for the compare, so every
registered query ends in the same projection: integral columns as BIGINT,
floating columns as DOUBLE rounded to ``SNAP`` and then ``DIGITS`` places
(float sums are not order-stable between engines: a value that is exactly
x.xxxx5 in decimal may come out a hair above in one engine and below in
the other; the first rounding snaps both to the same decimal),
dates/timestamps/text unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIGITS = 4
SNAP = 8  # first rounding step: removes summation-order noise (~1e-16 relative)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType, T.DecimalType)


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, _INTEGRAL):
        return "int"
    if isinstance(dt, _FLOATING):
        return "double"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dt, T.BooleanType):
        return "bool"
    return "text"


def normalize_df(df: DataFrame) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        k = kind_of(f.dataType)
        c = f"`{f.name}`"
        if k == "int":
            e = f"CAST({c} AS BIGINT)"
        elif k == "double":
            e = f"round(round(CAST({c} AS DOUBLE), {SNAP}), {DIGITS})"
        elif k == "timestamp":
            e = f"CAST({c} AS TIMESTAMP_NTZ)"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    return df.selectExpr(*exprs)


def duck_round(expr: str, digits: int) -> str:
    """DuckDB text rounding a DOUBLE the way Spark's ``round`` does.

    Spark rounds the shortest decimal form of the double half-up (0.285 ->
    0.29); DuckDB's ``round`` scales the binary value (0.285 -> 0.28).  Going
    through VARCHAR -> DECIMAL reproduces Spark; NaN/Infinity/huge values
    pass through.
    """
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) OR isinf({x}) OR abs({x}) >= 1e15 THEN round({x}, {digits}) "
            f"ELSE CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)), {digits}) AS DOUBLE) END)")


_DUCK = {"int": "CAST({c} AS BIGINT)", "double": duck_round(duck_round("{c}", SNAP), DIGITS),
         "date": "CAST({c} AS DATE)", "timestamp": "CAST({c} AS TIMESTAMP)",
         "bool": "CAST({c} AS BOOLEAN)", "text": "CAST({c} AS VARCHAR)"}


def normalize_sql(sql: str, spec: list[tuple[str, str]]) -> str:
    """Wrap oracle SQL in the same projection, given (column, kind) pairs."""
    sel = ",\n       ".join(_DUCK[k].format(c=f'q."{n}"') + f' AS "{n}"' for n, k in spec)
    return f"SELECT {sel}\nFROM (\n{sql}\n) AS q"
