"""Least squares from one pass of sums, safe for collinear columns (C16), and
dummy columns fixed on the training rows (R5).

Every group's counts, means and centred cross products come from one aggregate
(Spark's covariance merges centred sums, so large means cost no digits). A row
per group then holds the whole problem, whose size is the number of terms, and
is solved in place by a Cholesky that takes the columns in turn and passes over
those which the earlier ones already span. Nothing reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-9  # of a column's own sum of squares
CONSTANT = 1e-10  # a smaller deviation than this share of the mean is rounding


def cholesky_in_turn(c: np.ndarray, least: np.ndarray, tolerance: float = TOLERANCE) -> tuple[list[int], np.ndarray]:
    """(columns kept, lower factor of their block) of a symmetric positive
    semidefinite matrix; a column that the kept ones span, or whose own sum is not
    over ``least``, is passed over."""
    kept: list[int] = []
    low = np.zeros((0, 0))
    for j in range(len(c)):
        row = np.linalg.solve(low, c[kept, j]) if kept else np.zeros(0)
        rest = c[j, j] - row @ row
        if c[j, j] <= least[j] or rest <= tolerance * c[j, j]:
            continue
        low = np.block([[low, np.zeros((len(kept), 1))], [row[None], np.array([[math.sqrt(rest)]])]])
        kept.append(j)
    return kept, low


def incomplete_beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(1000):
        m = i // 2
        if i == 0:
            t = 1.0
        elif i % 2 == 0:
            t = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            t = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + t * d) or tiny)
        c = (1 + t / c) or tiny
        f *= c * d
        if abs(1 - c * d) < 1e-15:
            break
    return front * (f - 1)


def t_two_sided(t: float, freedom: float) -> float:
    """P(|T| >= |t|) of Student's t."""
    if math.isinf(t):
        return 0.0
    return incomplete_beta(freedom / (freedom + t * t), freedom / 2, 0.5)


def _solve(n: int, y_mean: float, means: np.ndarray, c: np.ndarray, xy: np.ndarray, yy: float) -> dict:
    """Coefficients (intercept first), errors, t and p; nan for terms passed over."""
    k = len(means)
    kept, low = cholesky_in_turn(c, n * (CONSTANT * means) ** 2)
    beta, error = np.full(k + 1, np.nan), np.full(k + 1, np.nan)
    inverse = np.linalg.inv(low) if kept else np.zeros((0, 0))
    inverse = inverse.T @ inverse
    b = inverse @ xy[kept]
    beta[0] = y_mean - means[kept] @ b
    beta[[i + 1 for i in kept]] = b
    rss = max(yy - xy[kept] @ b, 0.0)
    freedom = n - len(kept) - 1
    if freedom > 0:
        s2 = rss / freedom
        error[0] = math.sqrt(s2 * (1 / n + means[kept] @ inverse @ means[kept]))
        error[[i + 1 for i in kept]] = np.sqrt(s2 * np.diag(inverse))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = beta / error
    p = np.array([t_two_sided(v, freedom) if freedom > 0 and not np.isnan(v) else np.nan for v in t])
    return {"coef": beta, "std_err": error, "t_value": t, "p_value": p, "df_resid": freedom,
            "r2": 1 - rss / yy if yy > 0 else np.nan, "rank": len(kept) + 1}


def ols(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], intercept: str = "const") -> DataFrame:
    """(keys, term, coef, std_err, t_value, p_value, n, df_resid, r2, rank), a row
    per group and term. Rows with a null in ``y`` or any column take no part. A
    column that is constant or a combination of earlier ones has nulls; so have
    errors, t and p without residual degrees of freedom."""
    k = len(xs)
    cols = [y, *xs]
    rows = df.dropna(subset=cols).select(*keys, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_n"), F.array(*[F.avg(f"_{i}") for i in range(k + 1)]).alias("_means"),
            F.array(*[F.covar_pop(f"_{i}", f"_{j}") for i in range(k + 1) for j in range(i, k + 1)]).alias("_cov")]
    sums = rows.groupBy(*keys).agg(*aggs).filter(F.col("_n") > 0)
    terms = [intercept, *xs]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keys],
                        "term string, coef double, std_err double, t_value double, p_value double, n long, df_resid long, r2 double, rank int"])

    def run(frames):
        upper = np.triu_indices(k + 1)
        for frame in frames:
            out = []
            for _, row in frame.iterrows():
                full = np.zeros((k + 1, k + 1))
                full[upper] = np.asarray(row["_cov"], float) * row["_n"]
                full += np.triu(full, 1).T
                got = _solve(int(row["_n"]), row["_means"][0], np.asarray(row["_means"], float)[1:], full[1:, 1:], full[0, 1:], full[0, 0])
                d = pd.DataFrame({"term": terms, **{c: got[c] for c in ("coef", "std_err", "t_value", "p_value")}, "n": int(row["_n"]),
                                  "df_resid": got["df_resid"], "r2": got["r2"], "rank": got["rank"]})
                for c in keys:
                    d.insert(0, c, [row[c]] * len(d))
                out.append(d)
            if out:
                all_rows = pd.concat(out)
                yield all_rows[[*keys, "term", "coef", "std_err", "t_value", "p_value", "n", "df_resid", "r2", "rank"]]

    fitted = sums.mapInPandas(run, schema)
    return fitted.select(*[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if c in ("coef", "std_err", "t_value", "p_value", "r2") else c
                           for c in fitted.columns])


def categories(train: DataFrame, col: str) -> list[str]:
    """Sorted non-null values of the training rows; each becomes a column."""
    return [r[0] for r in train.select(F.col(col).cast("string")).filter(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def dummies(col: str, values: Sequence[str], drop_first: bool = True) -> list[Column]:
    """0/1 columns ``col_value`` for the training categories, the first left
    out; a null or a value that training lacks is 0 in all of them."""
    kept = values[1:] if drop_first else values
    return [F.coalesce((F.col(col).cast("string") == v).cast("int"), F.lit(0)).alias(f"{col}_{v}") for v in kept]
