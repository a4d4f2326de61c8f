"""Global and grouped statistics.

``global_quantiles`` is exact like numpy's linear interpolation but never
gathers a column into one task: it narrows the rank range with distributed
histograms (a few thousand bucket counts reach the driver per round) and
collects only the last few candidate values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.operators.ranks import group_quantiles, wide_quantiles

HIST_BUCKETS = 4096
FINAL_CANDIDATES = 20000


def _select(sub: DataFrame, c: str, below: int, n: int, mn: float, mx: float,
            ranks: Sequence[int], depth: int = 0) -> dict[int, float]:
    """Order statistics for 0-based ``ranks`` that fall inside ``sub``
    (which holds the values ranked ``below`` .. ``below + n - 1``)."""
    x = F.col(c)
    if mn == mx:
        return {k: float(mn) for k in ranks}
    if n <= FINAL_CANDIDATES or depth >= 12:
        vals = sorted(r[0] for r in sub.select(x).collect())
        return {k: float(vals[k - below]) for k in ranks}
    width = (mx - mn) / HIST_BUCKETS
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(width)), F.lit(HIST_BUCKETS - 1))
    # one job per level: counts with each bucket's own min/max, so the next
    # level needs no extra pass to find its range
    hist = sorted((r["b"], r["n"], r["mn"], r["mx"]) for r in
                  sub.groupBy(b.alias("b")).agg(F.count(x).alias("n"), F.min(x).alias("mn"),
                                                F.max(x).alias("mx")).collect())
    out: dict[int, float] = {}
    acc = below
    for bi, cnt, bmn, bmx in hist:
        inside = [k for k in ranks if acc <= k < acc + cnt]
        if inside:
            # the same bucket expression as the count, so float rounding at
            # bucket edges cannot move a value between levels
            out.update(_select(sub.filter(b == F.lit(bi)), c, acc, cnt, bmn, bmx, inside, depth + 1))
        acc += cnt
    return out


def global_quantiles(df: DataFrame, c: str, qs: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation (numpy/pandas default,
    Spark ``percentile``, DuckDB ``quantile_cont``) over all non-null values."""
    base = df.select(c).filter(F.col(c).isNotNull())
    head = base.agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("mn"), F.max(c).alias("mx")).first()
    n = head["n"]
    if n == 0:
        return [None for _ in qs]
    ranks = set()
    for q in qs:
        k = math.floor(q * (n - 1))
        ranks.update({k, min(k + 1, n - 1)})
    vals = _select(base, c, 0, n, head["mn"], head["mx"], sorted(ranks))
    out = []
    for q in qs:
        pos = q * (n - 1)
        k = math.floor(pos)
        lo, hi = vals[k], vals[min(k + 1, n - 1)]
        frac = pos - k
        out.append(lo + (hi - lo) * frac if frac else lo)
    return out


def quantile_filter(df: DataFrame, c: str, lower: float | None = None,
                    upper: float | None = None) -> DataFrame:
    """Keep rows whose value lies within the given quantiles."""
    qs = [q for q in (lower, upper) if q is not None]
    vals = dict(zip(qs, global_quantiles(df, c, qs)))
    cond = F.lit(True)
    if lower is not None:
        cond = cond & (F.col(c) >= F.lit(vals[lower]))
    if upper is not None:
        cond = cond & (F.col(c) <= F.lit(vals[upper]))
    return df.filter(cond)


def _join_groups(df: DataFrame, rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """``df`` with the columns of its group's row, rows with null keys included."""
    key = "_qs_group"
    return (df.withColumn(key, F.struct(*group)).join(rows.withColumn(key, F.struct(*group)).drop(*group), key, "left").drop(key))


def winsorize_by(df: DataFrame, group: Sequence[str], cols: Sequence[str],
                 lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Per-group clip at the group's own quantiles, which are found for all
    columns at once without holding a group in one task."""
    j = _join_groups(df, wide_quantiles(df, group, cols, (lower, upper)), group)
    sel = []
    for f in df.columns:
        if f in cols:
            x = F.col(f)
            lo, hi = F.col(f"{f}_q0"), F.col(f"{f}_q1")
            sel.append(F.when(x.isNull(), None).when(x < lo, lo).when(x > hi, hi).otherwise(x).alias(f))
        else:
            sel.append(F.col(f))
    return j.select(*sel)


def zscore_by(df: DataFrame, group: Sequence[str], cols: Sequence[str], sample: bool = True,
              suffix: str = "") -> DataFrame:
    """(x - mean) / std within the group (std sample or population), from
    one aggregate for all columns that is joined back."""
    sd = F.stddev_samp if sample else F.stddev_pop
    moments = df.groupBy(*group).agg(*[x for c in cols for x in (F.avg(c).alias(f"_mean_{c}"), sd(c).alias(f"_sd_{c}"))])
    sel = []
    for f in df.columns:
        if f in cols:
            sel.append(((F.col(f) - F.col(f"_mean_{f}")) / F.nullif(F.col(f"_sd_{f}"), F.lit(0.0))).alias(f + suffix))
            if suffix:
                sel.append(F.col(f))
        else:
            sel.append(F.col(f))
    return _join_groups(df, moments, group).select(*sel)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one null count per column."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max per column as long rows; one
    scan for the moments and one pass for all quantiles."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]))
    moments = df.select(each.alias("_e")).select("_e.column", "_e.x").groupBy("column").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    q = group_quantiles(df, [], cols, (0.25, 0.5, 0.75)).select("column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def gram(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """X'X in one distributed pass (k(k+1)/2 sums), rows with any
    null dropped. Returns the small k x k matrix."""
    k = len(cols)
    clean = df.select(*cols).dropna()
    exprs = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g_{i}_{j}")
             for i in range(k) for j in range(i, k)]
    row = clean.agg(*exprs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"g_{i}_{j}"] or 0.0
    return g


def vif_uncentred(g: np.ndarray) -> np.ndarray:
    """VIF_i = G_ii * (G^-1)_ii for the uncentred (no intercept) regression
    of column i on the others. Singular -> inf."""
    try:
        inv = np.linalg.inv(g)
    except np.linalg.LinAlgError:
        inv = np.linalg.pinv(g)
        return np.where(np.abs(np.diag(g) * np.diag(inv)) > 0, np.inf, np.inf)
    v = np.diag(g) * np.diag(inv)
    return np.where(np.isfinite(v), v, np.inf)


def vif_elimination(df: DataFrame, cols: Sequence[str], threshold: float = 10.0
                    ) -> tuple[list[str], list[tuple[str, float]]]:
    """Drop the largest-VIF column while any VIF exceeds ``threshold``.
    The Gram matrix is computed once; dropping a column removes its row and
    column, no rescan. Returns (kept, [(removed, vif), ...])."""
    cols = list(cols)
    g = gram(df, cols)
    removed = []
    while len(cols) > 1:
        v = vif_uncentred(g)
        i = int(np.argmax(v))
        if not v[i] > threshold:
            break
        removed.append((cols[i], float(v[i])))
        g = np.delete(np.delete(g, i, 0), i, 1)
        cols.pop(i)
    return cols, removed


def minmax_winsorized(x: Column, lo: Column, hi: Column) -> Column:
    """C4: clip to [lo, hi] then scale to [0, 1]; constant column -> 0.5."""
    clipped = F.least(F.greatest(x, lo), hi)
    return F.when(x.isNull(), None).when(hi == lo, F.lit(0.5)).otherwise((clipped - lo) / (hi - lo))
