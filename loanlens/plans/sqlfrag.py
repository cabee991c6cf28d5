"""SQL twins of :mod:`loanlens.functions.exprs` for the DuckDB oracle strings."""

from __future__ import annotations


def cnt_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def money(c: str) -> str:
    return f"CAST(SUM({c}) AS DECIMAL(38,2))"


def avg_d(c: str) -> str:
    return f"(CAST(SUM({c}) AS DOUBLE) / COUNT({c}))"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def rnd(x: str, digits: int = 2) -> str:
    p = float(10 ** digits)
    return f"(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {p} + 0.5) / {p})"


def pct(num: str, den: str, digits: int | None = 2) -> str:
    v = f"({ratio(num, den)} * 100)"
    return v if digits is None else rnd(v, digits)
