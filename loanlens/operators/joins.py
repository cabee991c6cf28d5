"""Join operators.

Fact-fact joins (static x monthly) are equi-joins on the loan id: Spark
shuffles both sides on the key (sort-merge) and AQE splits a skewed partition.
Dimension joins leave the strategy to Spark's size-checked broadcast
(``spark.sql.autoBroadcastJoinThreshold``); only literal lookup tables of a fixed
size are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def join_inner_dim(fact: DataFrame, dim: DataFrame, *, fact_key: str, dim_key: str) -> DataFrame:
    """fact x dimension, inner."""
    return fact.join(dim, fact[fact_key] == dim[dim_key])


def join_inner_fact(static: DataFrame, monthly: DataFrame, *, on: str = "loan_id") -> DataFrame:
    """static x monthly on the loan id (both hash-partitioned on it)."""
    return static.join(monthly.withColumnRenamed("issuer_id", "m_issuer_id"), on)


def join_left(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str) -> DataFrame:
    return left.join(right, left[left_key] == right[right_key], "left")


def join_left_filtered(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, right_filter) -> DataFrame:
    """LEFT JOIN with a condition on the right side inside ON: filter the right side first."""
    return left.join(right.filter(right_filter), left[left_key] == right[right_key], "left")


def join_anti(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """NOT EXISTS: rows of ``df`` whose key is absent from ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def join_semi(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """EXISTS: rows of ``df`` whose key is present in ``other`` (each row once)."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def join_map(df: DataFrame, lookup: DataFrame, *, key: str, lookup_key: str | None = None) -> DataFrame:
    """Dictionary lookup: left join to a lookup table; Spark broadcasts it if its size is under the limit."""
    lk = lookup_key or key
    if lk == key:
        return df.join(lookup, key, "left")
    return df.join(lookup, df[key] == lookup[lk], "left").drop(lk)


def join_scenario(book: DataFrame, shock: DataFrame, *, key: str = "state_code", shock_key: str = "state") -> DataFrame:
    """Scenario shock by state, inner: states without a shock drop out."""
    return book.join(shock.withColumnRenamed(shock_key, key), key)


def join_panel(left: DataFrame, econ: DataFrame, *, how: str = "inner") -> DataFrame:
    """state-month panel x economy on (state, month)."""
    e = econ.withColumnRenamed("state", "property_state")
    return left.join(e, ["property_state", "report_date"], how)


def transition_self_join(snapshots: DataFrame, *, key: str = "cusip", order: str = "as_of_date") -> DataFrame:
    """What happens to each snapshot of a loan in every later snapshot.

    The reference pairs each snapshot with all later ones (a theta self-join,
    quadratic per loan).  The same facts come from one window over the following
    rows of the loan, ordered by date: number of later snapshots, their smallest
    and largest months delinquent, and whether any is a liquidation.  Output is
    one row per snapshot, linear in the input; one shuffle on the loan id.
    """
    later = (Window.partitionBy(key).orderBy(order)
             .rowsBetween(1, Window.unboundedFollowing))
    liq = F.when(F.col("current_month_liquidation") == "Y", 1).otherwise(0)
    return snapshots.select(
        key, order, "property_state", "months_delinquent",
        F.count(F.lit(1)).over(later).alias("later_count"),
        F.min("months_delinquent").over(later).alias("later_min_months"),
        F.max("months_delinquent").over(later).alias("later_max_months"),
        F.max(liq).over(later).alias("later_liquidated"))


def dedupe_first(df: DataFrame, keys, order_by, *, tasks: int | None = None) -> DataFrame:
    """One row per key (null keys dropped), the first by an explicit total order.

    ``row_number() = 1`` lets Spark plan a map-side ``WindowGroupLimit`` before the
    shuffle: every task sends at most one row per key, so a hot key (a third of
    the rows) costs one row per task, not one task holding the whole key.

    With ``tasks`` the rows are dealt by key to that many tasks before the terms of the order are made, so a large
    table with few rows per key is sorted once, in parts that grow no larger with it; a hot key is then in one task.
    """
    keys = list(keys)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    w = Window.partitionBy(*keys).orderBy(*order_by)
    rows = df.filter(cond)
    rows = rows.repartition(tasks, *keys) if tasks else rows
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
