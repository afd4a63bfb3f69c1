"""Set operations: UNION ALL, UNION, and a union whose second
arm only fills some columns (the rest typed NULL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def pad_to(df: DataFrame, like: DataFrame) -> DataFrame:
    """Project ``df`` onto the columns and types of ``like``; absent columns
    become typed NULLs."""
    have = set(df.columns)
    exprs = [f"CAST({'`' + f.name + '`' if f.name in have else 'NULL'} AS "
             f"{f.dataType.simpleString()}) AS `{f.name}`" for f in like.schema.fields]
    return df.selectExpr(*exprs)


def union_null_padded(full: DataFrame, partial: DataFrame, distinct: bool = True) -> DataFrame:
    out = full.unionByName(pad_to(partial, full))
    return out.distinct() if distinct else out
