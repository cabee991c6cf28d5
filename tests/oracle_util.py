"""Order-insensitive comparison of a Spark result with an oracle result (pandas frames)."""

import decimal
import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") or len(s) == 10 else s
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(norm(x) for x in rec) for rec in df[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def assert_same(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, key: str = ""):
    c1, r1 = canon(spark_pdf)
    c2, r2 = canon(oracle_pdf)
    assert c1 == c2, f"{key}: columns {c1} != {c2}"
    assert len(r1) == len(r2), f"{key}: rows {len(r1)} != {len(r2)}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    assert not bad, f"{key}: values differ, e.g. {bad[:2]}"
