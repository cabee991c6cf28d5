"""Sorts, limits, top-k and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_limit(df: DataFrame, order, n: int) -> DataFrame:
    """ORDER BY ... LIMIT n (Spark plans TakeOrderedAndProject: a per-partition top-n, then a merge)."""
    return df.orderBy(*order).limit(n)


def nlargest(df: DataFrame, col: str, n: int = 10, tie: list[str] | None = None) -> DataFrame:
    """The ``n`` largest by ``col``, nulls last; ties broken by ``tie`` columns."""
    return df.orderBy(F.desc_nulls_last(col), *[F.asc(t) for t in (tie or [])]).limit(n)


def sort_panel(df: DataFrame, keys=("property_state", "tier", "report_date")) -> DataFrame:
    """Panel order for display; operators use window ordering instead of a global sort."""
    return df.orderBy(*keys)


def sort_result(df: DataFrame, col: str, n: int = 10, tie: str | None = None) -> DataFrame:
    return df.orderBy(F.desc(col), *([F.asc(tie)] if tie else [])).limit(n)


def mean_line(df: DataFrame, col: str, top_n: int | None = None, tie: str | None = None) -> DataFrame:
    """One row: mean of ``col`` over all rows and over the ``top_n`` largest."""
    all_mean = df.agg(F.avg(col).alias("all_mean"))
    if not top_n:
        return all_mean
    top = nlargest(df, col, top_n, [tie] if tie else None)
    return all_mean.withColumn("top_mean", top.agg(F.avg(col)).scalar())


def union_all(frames) -> DataFrame:
    """Concatenate frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()
