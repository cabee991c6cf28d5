"""Column helpers shared by the operators.

Averages and ratios are computed from exact sums (integers and decimals) and
converted to double once, so the value does not depend on the order in which
partitions are combined.  ``rnd`` rounds a double half away from zero with
plain arithmetic, which gives the same answer on every engine (``round`` on
doubles does not: it differs between engines on values such as 1.005).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM = "decimal(38,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cnt_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def money(c) -> Column:
    """Sum of a money column as decimal(38,2) (exact)."""
    return F.sum(col(c)).cast(MONEY_SUM)


def avg_d(c) -> Column:
    """Average as double from the exact sum: ``sum(c) / count(c)``; null if no values."""
    c = col(c)
    return F.sum(c).cast("double") / F.count(c)


def ratio(num, den) -> Column:
    """``num / den`` as double; null when the denominator is zero or null (reference divides by zero)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def rnd(c, digits: int = 2) -> Column:
    """Round a double half away from zero to ``digits`` places, engine-independently."""
    c = col(c).cast("double")
    p = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * p + 0.5) / p


def pct(num, den, digits: int | None = 2) -> Column:
    """``ROUND(num / den * 100, digits)`` as double."""
    v = ratio(num, den) * 100
    return v if digits is None else rnd(v, digits)


def clean_double(c) -> Column:
    """Cast to double with bad text and NaN mapped to null (pandas treats both as missing)."""
    v = F.expr(f"try_cast({c} AS double)") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def with_rounded(df, name: str, value: Column, digits: int = 2):
    """``df`` plus ``name = rnd(value, digits)``, with ``value`` in a projection of its own.

    ``rnd`` reads its input twice (sign and magnitude).  When the input holds a
    scalar subquery (a grand total), computing it in its own column first keeps
    the subquery to one evaluation: one scan of the total instead of two.
    """
    raw = f"_{name}_raw"
    return df.withColumn(raw, value.cast("double")).withColumn(name, rnd(raw, digits)).drop(raw)


def with_total(df, name: str, value):
    """``df`` (grouped rows, a few per group value) plus ``name``: the sum of ``value`` over all its rows.

    For results whose row count is bounded by a dimension (states, months, buckets):
    the total comes from the grouped rows, so the fact is scanned once.
    """
    from pyspark.sql.window import Window

    return df.withColumn(name, F.sum(col(value)).over(Window.partitionBy()))


def with_pct(df, name: str, num, den, digits: int = 2):
    """``df`` plus ``name = ROUND(num / den * 100, digits)``; see :func:`with_rounded`."""
    return with_rounded(df, name, ratio(num, den) * 100, digits)
