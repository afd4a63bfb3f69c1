"""Joins.

Size policy: no join forces a broadcast of data, and the roster's joins rule it out.  Elsewhere, with AQE on, a side that turns out
small at run time is broadcast after its measured size is checked against
``spark.sql.autoBroadcastJoinThreshold``, otherwise it stays a shuffle join and
skewed partitions are split.  Two things are broadcast by hint: the list of heavy keys of
``split_left_join``, which has at most ``HEAVY_KEYS`` rows by construction, and the scorecard's contact days,
one row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_key
from .filters import normalised

# The agent role and area of the scorecard roster filter.
EMAIL_ROLE = "E-MAIL"
PRIMARY_AREA = "RELACIONAMENTO PRIMÁRIO"


def roster_filter(roster: DataFrame, mode: str = "upper") -> DataFrame:
    """E-mail agents of the primary relationship area.

    mode='upper': upper(funcao)/upper(area) compare (most of the scorecard);
    mode='lower': the lower-case spelling (same rows);
    mode='exact': funcao compared as written, area upper-cased (the final
    roster join of the scorecard).
    """
    f, a = F.col("funcao"), F.col("area")
    if mode == "upper":
        cond = (F.upper(f) == EMAIL_ROLE) & (F.upper(a) == PRIMARY_AREA)
    elif mode == "lower":
        cond = (F.lower(a) == PRIMARY_AREA.lower()) & (F.lower(f) == EMAIL_ROLE.lower())
    elif mode == "exact":
        cond = (f == EMAIL_ROLE) & (F.upper(a) == PRIMARY_AREA)
    else:
        raise ValueError(mode)
    return roster.filter(cond)


def month_roster_join(df: DataFrame, roster: DataFrame, date_col: str,
                      key: str = "matricula", how: str = "inner",
                      roster_cols: list[str] | None = None) -> DataFrame:
    """Attach the roster row of the same employee and month.

    ``month(a)=month(b) AND year(a)=year(b)`` becomes one equi-key
    ``trunc(date,'MM')``, so the join hash-partitions on (employee, month).  It is a merge join by hint: the
    roster grows with employees and months, but the planner takes one that is expanded from a short table (or
    a month list) for as small as that table, and a copy of it would be held by every task.
    """
    cols = roster_cols if roster_cols is not None else [
        c for c in roster.columns if c not in (key, "mes_referencia")]
    r = roster.selectExpr(f"`{key}` AS _rk", "trunc(to_date(mes_referencia), 'MM') AS _rym",
                          *[f"`{c}`" for c in cols])
    left = df.selectExpr("*", f"trunc(to_date(`{date_col}`), 'MM') AS _ym")
    out = left.join(r.hint("merge"), (left[key] == r["_rk"]) & (left["_ym"] == r["_rym"]), how)
    return out.drop("_rk", "_rym", "_ym")


def month_roster_counts(df: DataFrame, roster: DataFrame, date_col: str, cols: list[str | Column],
                        key: str = "matricula", how: str = "inner") -> DataFrame:
    """:func:`month_roster_join` with equal roster rows taken together.

    Each row of ``df`` comes once for every different combination of ``cols`` among the roster rows of its
    employee and month, with ``_rows``: how many roster rows have it (1 where a left join finds none).
    Where ``df`` has one row per (employee, day), so has the result per combination: a sum over the joined rows
    is the value times ``_rows`` and needs no further table of groups in the task.
    """
    r = roster.select(F.col(key).alias("_rk"), F.expr("trunc(to_date(mes_referencia), 'MM')").alias("_rym"), *cols)
    # dealt out first: a roster expanded from a short table may come from a single task
    r = r.repartition("_rk", "_rym").groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_rows"))
    left = df.selectExpr("*", f"trunc(to_date(`{date_col}`), 'MM') AS _ym")
    out = left.join(r.hint("merge"), (left[key] == r["_rk"]) & (left["_ym"] == r["_rym"]), how)
    if how == "left":
        out = out.withColumn("_rows", F.coalesce("_rows", F.lit(1)))
    return out.drop("_rk", "_rym", "_ym")


def targets_for(targets: DataFrame, indicator: str, tipo: str | None = "individual",
                origem: str | None = "PRIMARIO", trim_tipo: bool = True,
                origem_case: str = "upper") -> DataFrame:
    """Target rows of one indicator: lower(indicador), lower([trimmed] tipo),
    upper/lower(origem).  Returns (ym, m_*, p_*, tipo, origem); bounded by one
    row per month for each matching (tipo, origem)."""
    conds = [f"lower(indicador) = '{indicator.lower()}'"]
    if tipo is not None:
        col = "trim(tipo)" if trim_tipo else "tipo"
        conds.append(f"lower({col}) = '{tipo.lower()}'")
    if origem is not None:
        fn = "upper" if origem_case == "upper" else "lower"
        conds.append(f"{fn}(origem) = '{origem.upper() if fn == 'upper' else origem.lower()}'")
    bands = [c for c in targets.columns if c[:2] in ("m_", "p_")]
    return targets.where(" AND ".join(conds)).selectExpr(
        "trunc(to_date(ref), 'MM') AS ym", *bands, "tipo", "origem")


def month_target_join(df: DataFrame, targets: DataFrame, month_col: str = "ym",
                      drop_meta: bool = True) -> DataFrame:
    """Attach target rows by month (inner: the warehouse query filters on
    target columns after a LEFT JOIN, which keeps matches only).  ``targets``
    comes from :func:`targets_for`; its measured size decides between a
    broadcast and a shuffle join."""
    t = targets.withColumnRenamed("ym", "_tym")
    if drop_meta:
        t = t.drop("tipo", "origem")
    out = df.join(t, df[month_col] == t["_tym"], "inner")
    return out.drop("_tym")


def employee_day_spine(calendar: DataFrame, roster: DataFrame, date_col: str = "created",
                       start=None) -> DataFrame:
    """Every rostered employee x every distinct contact day of that month.

    The days become one row per month (a list of at most 31), the roster side
    distinct (employee, month): the month join meets one row per month, and the
    list is expanded behind it, so the output is already distinct.
    """
    days = calendar.select(F.to_date(date_col).alias("dia"))
    if start is not None:
        days = days.filter(F.col("dia") >= F.lit(start))
    days = days.distinct().groupBy(month_key("dia").alias("_ym")).agg(
        F.collect_list("dia").alias("_days"))
    people = roster.select("matricula", month_key("mes_referencia").alias("_ym")).distinct()
    return people.join(days, "_ym").select(F.explode("_days").alias("dia"), "matricula")


#: A key is heavy with more than this fraction of all rows, so there are fewer heavy keys than this.
HEAVY_KEYS = 1000


def heavy_keys(df: DataFrame, keys: list[str], least_rows: int = 10_000) -> DataFrame:
    """The keys that hold more than 1/``HEAVY_KEYS`` of all rows, and more than ``least_rows``: the keys and
    ``_parts``, into how many parts of about that size their rows should go.

    A count over the key columns alone, partial before its shuffle.  Less than ``HEAVY_KEYS`` rows, whatever the data.
    """
    counts = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.select(F.sum("_rows")).scalar()  # over the same shuffle, which AQE runs once
    bound = F.greatest(F.lit(least_rows), F.coalesce(total, F.lit(0)) / F.lit(HEAVY_KEYS))
    return counts.filter(F.col("_rows") > bound).select(
        *keys, F.least(F.lit(HEAVY_KEYS), F.ceil(F.col("_rows") / bound)).cast("int").alias("_parts"))


def split_left_join(left: DataFrame, right: DataFrame, keys: list[str], least_rows: int = 10_000) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``keys``, where a key may have very many right rows.

    A left outer join can be split on its left side alone, so a heavy right key stays in one task.  Here the right
    rows of a heavy key are dealt over parts by a hash of the row, and the left rows of that key go to each of
    the parts.  A left row may find nothing in one of them; as its key has rows, such an
    empty answer is dropped.  Left rows of other keys, matched or not, go once, and each side is evaluated once
    (the count reads the key columns of ``right``).  Right rows equal in every column go to one part.
    """
    heavy = F.broadcast(heavy_keys(right, keys, least_rows))
    mine = left.join(heavy, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    row = F.xxhash64(*right.columns)
    theirs = right.join(heavy, keys, "left").withColumn(
        "_part", F.pmod(row, F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts").withColumn("_found", F.lit(True))
    out = mine.join(theirs, [*keys, "_part"], "left").filter(F.col("_parts").isNull() | F.col("_found").isNotNull())
    return out.drop("_part", "_parts", "_found")


def try_long(c) -> Column:
    """Text/number key to BIGINT; unparsable text becomes NULL (never matches)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("bigint")


def cast_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  how: str = "inner", also: list[tuple[str, str]] | None = None) -> DataFrame:
    """Join where one side holds the key as text; ``also`` lists further (left, right)
    columns that must be equal."""
    r = right.withColumn("_ck", try_long(right_key))
    cond = left[left_key] == r["_ck"]
    for a, b in also or []:
        cond = cond & (left[a] == r[b])
    return left.join(r, cond, how).drop("_ck")


# Digits used to encode one ordering column into a sortable DECIMAL(38,0)
# code: value + offset lands in [1, 10^digits); 0 is NULL (lowest, as in a
# struct comparison).
_CODE_PARTS = {
    T.TimestampNTZType: (18, "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})",
                         70_000_000_000_000_000),
    T.TimestampType: (18, "unix_micros({c})", 70_000_000_000_000_000),
    T.DateType: (7, "unix_date({c})", 4_000_000),
    T.LongType: (20, "{c}", 2 ** 63 + 1),
    T.IntegerType: (10, "{c}", 2 ** 31 + 1),
    T.ShortType: (5, "{c}", 2 ** 15 + 1),
    T.ByteType: (3, "{c}", 2 ** 7 + 1),
}
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                T.TimestampNTZType)


def order_code(df: DataFrame, order_by: list[str]) -> str | None:
    """SQL for a DECIMAL(38,0) that sorts exactly like the tuple ``order_by``
    (NULL lowest), or None when the columns do not fit in 38 digits."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts, width = [], 0
    for c in order_by:
        spec = _CODE_PARTS.get(type(types.get(c)))
        if spec is None:
            return None
        digits, expr, offset = spec
        parts.append((digits, f"CASE WHEN `{c}` IS NULL THEN CAST(0 AS DECIMAL(38,0)) ELSE "
                              f"CAST({expr.format(c=f'`{c}`')} AS DECIMAL(38,0)) + "
                              f"CAST({offset} AS DECIMAL(38,0)) END"))
        width += digits
    if width > 38:
        return None
    code, shift = None, 0
    for digits, part in reversed(parts):
        term = part if shift == 0 else f"({part}) * CAST(1{'0' * shift} AS DECIMAL(38,0))"
        code = term if code is None else f"{term} + {code}"
        shift += digits
    return code


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                   payload: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` tuple.

    A ``max_by`` aggregate, so partial aggregation runs before the shuffle
    and a hot key costs one row per map task, not one sort of its group.
    Put a unique column last in ``order_by`` to make ties deterministic.

    When the ordering columns are timestamps/dates/integers that fit one
    DECIMAL(38,0) code and the payload is fixed-width, each payload column is
    a ``max_by`` over that code: all aggregation buffers are fixed-width, so
    Spark uses a hash aggregate instead of sorting every map partition.
    Otherwise the payload and the order are compared as structs.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    code = order_code(df, order_by)
    if code is not None and all(isinstance(types[c], _FIXED_WIDTH) for c in payload):
        coded = df.select(*keys, *dict.fromkeys(payload), F.expr(code).alias("_order"))
        return coded.groupBy(*keys).agg(
            *[F.max_by(c, "_order").alias(c) for c in payload])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]),
                    F.struct(*[F.col(c) for c in order_by]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")
