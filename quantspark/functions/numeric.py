"""Null-safe scalar expressions shared by all operators.

ANSI mode raises on ``x/0`` and on ``ln`` of non-positive numbers only in
some paths; these helpers return NULL instead, the way the DuckDB oracle
does with ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(col(a), F.nullif(col(b), F.lit(0)))


def safe_ln(x: str | Column) -> Column:
    """ln(x) for x > 0, else NULL (pandas gives -inf / NaN there)."""
    x = col(x)
    return F.when(x > 0, F.ln(x))


def clip(x: str | Column, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """pandas ``clip``: NULL stays NULL (``greatest``/``least`` would skip it)."""
    x = col(x)
    out = x
    if lo is not None:
        out = F.when(out < lo, lo).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, hi).otherwise(out)
    return F.when(x.isNull(), None).otherwise(out)


def inf_to_null(x: str | Column) -> Column:
    x = col(x)
    return F.when(x.isin(float("inf"), float("-inf")) | F.isnan(x), None).otherwise(x)


def normal_cdf(x: str | Column) -> Column:
    """standard normal CDF via Abramowitz-Stegun 7.1.26 (|err| < 1.5e-7),
    written so that DuckDB can evaluate the same polynomial."""
    x = col(x)
    z = F.abs(x) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * F.exp(-z * z)
    return 0.5 * (1.0 + F.signum(x) * erf)


def qcut_of_rank(r: str | Column, n: str | Column, q: int = 5) -> Column:
    """Group (0..q-1) of rank r in 1..n that pandas ``qcut(rank, q)`` gives
    (differs from ``ntile`` when n mod q != 0). Integer arithmetic."""
    r, n = col(r), col(n)
    g = F.floor(((r - 1) * q + (n - 2)) / (n - 1)) - 1
    return (F.when(n == 1, F.lit(0))
             .when(r == 1, F.lit(0))
             .otherwise(g)).cast("int")


def binomial_moe(acc: str | Column, n: str | Column, z: float = 1.96) -> Column:
    """C17: ``z * sqrt(a(1-a)/n)``."""
    a = col(acc)
    return z * F.sqrt(a * (1 - a) / col(n))
