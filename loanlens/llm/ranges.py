"""Rows dealt into buckets of ascending doc_id, about as many rows in each."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BUCKETS = 1 << 16  # bounds that the driver holds at most


def range_bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """The bucket (0 ..) of each row by ``key``: ascending, null keys first, equal keys together.

    Bounds are approximate quantiles of the key, one array of MAX_BUCKETS numbers at most.
    They are looked up in two steps of about the square root of their number each.
    """
    buckets = max(1, min(buckets, MAX_BUCKETS))
    share = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, share, 100 * buckets).alias("b")).first()["b"] if share else None
    bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) or 1
    coarse, fine = F.lit(bounds[::step]), F.lit(bounds)

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b < F.col(key)))

    at = below(coarse)  # coarse bounds under the key; the last of them is where the fine ones begin
    inside = F.slice(fine, F.greatest(at - 1, F.lit(0)) * step + 1, F.lit(step))
    return F.when(F.col(key).isNull() | (at == 0), 0).otherwise((at - 1) * step + below(inside)).cast("int")
