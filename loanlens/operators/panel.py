"""Panel time-series operators: positional lags, yearly changes, gaps, fills, correlations.

All windows partition by the series key (state, or state x tier) and order by
month, so a window partition holds one series: its length is the number of
months, bounded by time and never by the number of loans.  Without a series key
(``by=()``) the frame must be one aggregated series, a national one say: it is
one window partition.  Lags are positional (``lag(c, 12)`` is 12 rows back),
which is what the reference's ``diff(12)`` does; with ``calendar`` they are the
value exactly so many months earlier, null where that month is missing.
``drop_gap_series`` removes series where rows are not consecutive months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _w(by, order_by):
    by = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*by).orderBy(order_by) if by else Window.orderBy(order_by)


def earlier(col: str, n: int, by, order_by: str, calendar: bool = False) -> Column:
    """The value ``n`` rows earlier in the series, or ``n`` months earlier by the calendar."""
    if not calendar:
        return F.lag(col, n).over(_w(by, order_by))
    month = F.year(order_by) * 12 + F.month(order_by)
    return F.first(col).over(_w(by, month).rangeBetween(-n, -n))


def diff_n(df: DataFrame, *, by, order_by: str, col: str, n: int = 12, name: str | None = None,
           calendar: bool = False) -> DataFrame:
    """``c - lag(c, n)`` within each series (pandas ``groupby().diff(n)``)."""
    return df.withColumn(name or f"{col}_chg", F.col(col) - earlier(col, n, by, order_by, calendar))


def pct_change_n(df: DataFrame, *, by, order_by: str, col: str, n: int = 12, name: str | None = None,
                 scale: float = 100.0, calendar: bool = False) -> DataFrame:
    """``(c / lag(c, n) - 1) * scale``, no filling; null when the earlier value is 0 or missing."""
    prev = earlier(col, n, by, order_by, calendar)
    return df.withColumn(name or f"{col}_pct_chg",
                         (F.try_divide(F.col(col).cast("double"), prev.cast("double")) - 1) * scale)


def shift_lag(df: DataFrame, *, by, order_by: str, col: str, k: int, name: str | None = None,
              calendar: bool = False) -> DataFrame:
    """Value ``k`` rows (with ``calendar``: months) earlier in the series."""
    return df.withColumn(name or f"{col}_lag{k}", earlier(col, k, by, order_by, calendar))


def lag_correlation(df: DataFrame, *, y: str, x: str, max_lag: int = 12, by=(), order_by: str = "report_date",
                    lag_by=None) -> DataFrame:
    """Pearson correlation of ``y`` with ``x`` shifted 0..max_lag rows; one row per lag.

    All lag columns come from one window pass (partitioned by ``lag_by``, the
    series key used for shifting); ``F.corr`` per lag then runs in one
    aggregation, using complete pairs only.  ``by`` groups the result.
    """
    lb = list(lag_by) if lag_by is not None else list(by)
    w = _w(lb, order_by)
    d = df.select(*[F.col(c) for c in dict.fromkeys([*by, *lb, order_by, y])],
                  *[F.lag(x, k).over(w).alias(f"_x{k}") for k in range(max_lag + 1)])
    g = d.groupBy(*by) if by else d.groupBy()
    wide = g.agg(*[F.corr(y, f"_x{k}").alias(f"c{k}") for k in range(max_lag + 1)])
    stack = ", ".join(f"{k}, c{k}" for k in range(max_lag + 1))
    return wide.selectExpr(*by, f"stack({max_lag + 1}, {stack}) AS (lag, corr)")


def feature_correlation(df: DataFrame, cols) -> DataFrame:
    """Correlation matrix of ``cols`` as rows (a, b, corr), complete cases over all ``cols``."""
    cols = list(cols)
    d = df.dropna(subset=cols)
    pairs = [(a, b) for a in cols for b in cols]
    wide = d.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, corr)")


def gap_count(df: DataFrame, *, by, order_by: str = "report_date", days: int = 31) -> DataFrame:
    """Per series, the number of steps longer than ``days`` days."""
    by = [by] if isinstance(by, str) else list(by)
    step = F.datediff(F.col(order_by), F.lag(order_by, 1).over(_w(by, order_by)))
    return (df.select(*by, order_by).withColumn("_gap", F.when(step > days, 1).otherwise(0))
            .groupBy(*by).agg(F.sum("_gap").cast("bigint").alias("gaps")))


def drop_gap_series(df: DataFrame, *, by, order_by: str = "report_date", days: int = 31) -> DataFrame:
    """Drop every series that has a gap (the reference's tier panel rule).

    Two windows on the series key (a step flag, then its maximum over the
    series) instead of an anti-join against the gapped keys: the panel is
    evaluated once, and the one hash partitioning on the key also serves the
    lag windows that follow.  Rows with a null key are kept, as an anti-join
    on the key would keep them.
    """
    by = [by] if isinstance(by, str) else list(by)
    step = F.datediff(F.col(order_by), F.lag(order_by, 1).over(_w(by, order_by)))
    keep = F.col("_series_gap") == 0
    for b in by:
        keep = keep | F.col(b).isNull()
    return (df.withColumn("_step_gap", F.when(step > days, 1).otherwise(0))
            .withColumn("_series_gap", F.max("_step_gap").over(Window.partitionBy(*by)))
            .filter(keep).drop("_step_gap", "_series_gap"))


def ffill(df: DataFrame, *, by, order_by: str, col: str) -> DataFrame:
    """Forward fill within each series: the last non-null value so far."""
    w = _w(by, order_by).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w))


def legacy_share(df: DataFrame, *, by="property_state", order_by: str = "report_date", n: int = 12,
                 calendar: bool = False) -> DataFrame:
    """legacy / loans * 100 and its change over ``n`` rows."""
    d = df.withColumn("legacy_share", rate(F.col("legacy_loans"), F.col("loan_count")))
    return diff_n(d, by=by, order_by=order_by, col="legacy_share", n=n, name="legacy_chg", calendar=calendar)


def interaction(df: DataFrame, a: str, b: str, name: str, scale: float = 100.0) -> DataFrame:
    """Product of two columns divided by ``scale`` (lagged HPI change x legacy share / 100)."""
    return df.withColumn(name, F.col(a) * F.col(b) / scale)


def rate(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double")) * 100
