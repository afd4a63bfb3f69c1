"""Window-style operators.

Per-key "latest row" and "count on every row" are written as aggregates
(partial aggregation before the shuffle, so a hot key never lands whole in
one task).  A rank that must be kept on every row needs an ordered window;
``ranked`` cuts a key into buckets of its leading order value, and a bucket with very many
rows further at quantiles of that value, so a hot key is many windows of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import HEAVY_KEYS, heavy_keys


def _same_keys(a: DataFrame, b: DataFrame, keys: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[f"{prefix}{k}"])
    return cond


def partition_count(df: DataFrame, keys: list[str], col: str | None, alias: str,
                    counts: DataFrame | None = None) -> DataFrame:
    """COUNT(col) OVER (PARTITION BY keys) on every row.

    Counted with a partial aggregate and joined back null-safely (window
    partitions group NULL keys together, so the join must too).  ``counts``
    (keys and ``alias``) may be given where they can be had from less than a
    second evaluation of ``df``.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(
            (F.count(F.col(col)) if col else F.count(F.lit(1))).alias(alias))
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], alias)
    joined = df.join(counts, _same_keys(df, counts, keys, "_k_"), "inner")
    return joined.drop(*[f"_k_{k}" for k in keys])


#: Distinct rows of a (key, bucket) that are ranked in one window.
WINDOW_ROWS = 100_000


def _null_safe(df: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``df`` with the other columns of ``small`` (a few rows, broadcast), NULL keys equal."""
    other = small.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    return df.join(F.broadcast(other), _same_keys(df, other, keys, "_s_"), how).drop(*[f"_s_{k}" for k in keys])


def _cuts(base: DataFrame, keys: list[str], value: str, least_rows: int) -> DataFrame:
    """For each heavy combination of ``keys``: quantiles of ``value`` that cut it into parts of bounded size.

    Heavy combinations are few by construction (``heavy_keys``), and so are all their cuts together; a
    quantile sketch has a bounded state and is merged, so no list of rows is built.
    """
    rows = _null_safe(base.select(*keys, value), heavy_keys(base, keys, least_rows), keys, "inner")
    sketch = rows.groupBy(*keys, "_parts").agg(
        F.percentile_approx(value, [i / HEAVY_KEYS for i in range(HEAVY_KEYS + 1)], 4 * HEAVY_KEYS).alias("_q"))
    cut = f"element_at(_q, CAST({HEAVY_KEYS}L * i / _parts AS INT) + 1)"
    return sketch.selectExpr(*keys, f"array_distinct(transform(sequence(1, _parts - 1), i -> {cut})) AS _cuts")


def ranked(df: DataFrame, keys: list[str], order: list[Column], alias: str = "rn",
           tie_cols: list[str] | None = None, bucket: Column | None = None,
           descending: bool = True, value: Column | None = None, least_rows: int = WINDOW_ROWS) -> DataFrame:
    """Row number per key under ``order``; ties go by a hash of ``tie_cols``.

    Without ``bucket`` this is the plain window, which sorts each key in one
    task.  ``bucket`` is a coarser form of the leading order value (the day of a
    timestamp): rows of a lower bucket never precede those of a higher one
    (``descending``) or the reverse.  Rows equal in every column are counted first: they take consecutive
    numbers, whichever of them takes which.  Then the distinct rows are numbered within (key, bucket), the rows of the
    buckets before are counted with a partial aggregate and summed up over the few buckets of a key, and
    the two are joined on (key, bucket).  ``value``, the leading order value as a whole number, lets a
    bucket of more than ``least_rows`` distinct rows be cut further, at quantiles of its values, so that all rows of
    a key on one day are still many windows.  Every side follows from row values alone, so the
    result does not depend on how Spark happens to partition any of them.
    """
    tie = F.xxhash64(*[F.col(c) for c in (tie_cols if tie_cols is not None else df.columns)])
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order, tie.asc())
        return df.withColumn(alias, F.row_number().over(w))
    base = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", bucket)
    parts = ["_bucket"]
    if value is not None:
        base = base.withColumn("_value", value)
        cuts = _cuts(base, [*keys, "_bucket"], "_value", least_rows)
        base = _null_safe(base, cuts, [*keys, "_bucket"], "left").withColumn(
            "_cut", F.expr("CASE WHEN _cuts IS NULL THEN 0 ELSE size(filter(_cuts, c -> c < _value)) END")).drop("_cuts", "_value")
        parts = ["_bucket", "_cut"]
    local = Window.partitionBy(*keys, *parts).orderBy(*order, tie.asc()).rowsBetween(Window.unboundedPreceding, -1)
    numbered = base.withColumn("_local", F.coalesce(F.sum("_n").over(local), F.lit(0)))
    first = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in parts]
    before = Window.partitionBy(*keys).orderBy(*first).rowsBetween(Window.unboundedPreceding, -1)
    sizes = base.groupBy(*keys, *parts).agg(F.sum("_n").alias("_rows"))
    offsets = sizes.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, *parts]],
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    out = numbered.join(offsets, _same_keys(numbered, offsets, [*keys, *parts], "_o_"), "inner")
    return out.select(*[numbered[c] for c in df.columns],
                      F.explode(F.sequence(F.col("_local") + F.col("_off") + 1, F.col("_local") + F.col("_off") + F.col("_n"))
                                ).alias(alias)).withColumn(alias, F.col(alias).cast("int"))
