"""Hourly volatility feature set (D1, D2) and its building blocks
(W1-W11, W21, C9).

All features are row-based windows over one series of bars; the guard in
``rolling`` reproduces the "needs w non-null rows" rule. The whole set is
three window levels over one partitioning, so Spark sorts each series once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quantspark.functions.numeric import safe_ln
from quantspark.operators.ordered import ordered_select, rolling, forward

# Fixed parameters of the feature set (must stay as given for equal results).
VOLATILITY_WINDOWS = (6, 24, 72, 168)
RETURN_WINDOWS = (6, 24, 72)
VOLUME_WINDOWS = (24, 168)
REGIME_WINDOWS = (24, 72, 168)
FORWARD_HORIZONS = (1, 4, 24)
EXTREME_PERCENTILE = 0.75
ANNUALISE = math.sqrt(365 * 24)
EPS = 1e-10
# Column-name patterns that mark non-features (case-sensitive substrings).
NON_FEATURE_PATTERNS = ("Open", "High", "Low", "Close", "Volume", "target_", "log_return")

BACK = 168   # deepest look-back of any feature, in rows
FWD = 24     # deepest look-ahead of any target, in rows


def calendar_features(ts: str = "bar_ts") -> list[Column]:
    """Cyclical hour / weekday / ISO-week encodings and weekend flag."""
    hour = F.hour(ts)
    dow = F.weekday(ts)            # Monday = 0
    week = F.weekofyear(ts)        # ISO week
    two_pi = 2 * math.pi
    return [
        hour.alias("hour"),
        F.sin(two_pi * hour / 24).alias("hour_sin"),
        F.cos(two_pi * hour / 24).alias("hour_cos"),
        dow.alias("day_of_week"),
        F.sin(two_pi * dow / 7).alias("day_sin"),
        F.cos(two_pi * dow / 7).alias("day_cos"),
        week.alias("week_of_year"),
        F.sin(two_pi * week / 52).alias("week_sin"),
        F.cos(two_pi * week / 52).alias("week_cos"),
        (dow >= 5).cast("int").alias("is_weekend"),
    ]


def _level_returns(w: WindowSpec) -> list[Column]:
    c, h, lo = F.col("close"), F.col("high"), F.col("low")
    prev = F.lag(c, 1).over(w)
    cols = [safe_ln(c / prev).alias("log_return"),
            F.pow(safe_ln(h / lo), 2).alias("_hl2"),
            F.greatest(h - lo, F.abs(h - prev), F.abs(lo - prev)).alias("_tr")]
    cols += [(c / F.lag(c, k).over(w) - 1).alias(f"return_{k}h") for k in RETURN_WINDOWS]
    return cols


def _level_features(w: WindowSpec) -> list[Column]:
    r, v, c = "log_return", "volume", "close"
    cols = []
    for n in VOLATILITY_WINDOWS:
        cols.append((rolling(F.stddev_samp, r, w, n) * ANNUALISE).alias(f"realized_vol_{n}h"))
        cols.append((F.sqrt(rolling(F.avg, "_hl2", w, n) / (4 * math.log(2))) * ANNUALISE)
                    .alias(f"parkinson_vol_{n}h"))
    for n in VOLATILITY_WINDOWS:
        cols.append((rolling(F.stddev_samp, v, w, n) / (rolling(F.avg, v, w, n) + EPS))
                    .alias(f"volume_volatility_{n}h"))
    cols.append(rolling(F.sum, r, w, 24).alias("return_momentum_24h"))
    cols.append(rolling(F.sum, r, w, 72).alias("return_momentum_72h"))
    cols.append((F.col("return_24h") - F.lag("return_24h", 24).over(w)).alias("return_acceleration"))
    for n in REGIME_WINDOWS:
        cols.append((rolling(F.avg, "_tr", w, n) / (F.col(c) + EPS)).alias(f"trend_strength_{n}h"))
    for n in REGIME_WINDOWS:
        rng = rolling(F.max, "high", w, n) - rolling(F.min, "low", w, n)
        cols.append((rng / (rolling(F.stddev_samp, c, w, n) * math.sqrt(n) + EPS))
                    .alias(f"range_vs_trend_{n}h"))
    for n in VOLUME_WINDOWS:
        ma = rolling(F.avg, v, w, n)
        cols.append(ma.alias(f"volume_ma_{n}h"))
        cols.append((F.col(v) / (ma + EPS)).alias(f"volume_ratio_{n}h"))
    for n in REGIME_WINDOWS:
        hi, lo = rolling(F.max, "high", w, n), rolling(F.min, "low", w, n)
        cols.append(((F.col(c) - lo) / (hi - lo + EPS)).alias(f"price_position_{n}h"))
    # W21 forward targets: partial tail, nulls skipped, no guard
    cols.append((F.abs(safe_ln(F.lead(c, 1).over(w) / F.col(c))) * ANNUALISE).alias("target_vol_1h"))
    for hzn in FORWARD_HORIZONS[1:]:
        cols.append((forward(F.stddev_samp, r, w, hzn) * ANNUALISE).alias(f"target_vol_{hzn}h"))
    return cols


def feature_columns(columns: Sequence[str]) -> list[str]:
    """Feature columns by name pattern (case-sensitive substrings)."""
    return [c for c in columns if not any(p in c for p in NON_FEATURE_PATTERNS)
            and not c.startswith("_") and c not in ("asset", "bar_ts", "open", "high", "low",
                                                      "close", "volume", "ticks")]


FEATURES = (
    [f"realized_vol_{n}h" for n in VOLATILITY_WINDOWS]
    + [f"parkinson_vol_{n}h" for n in VOLATILITY_WINDOWS]
    + [f"volume_volatility_{n}h" for n in VOLATILITY_WINDOWS]
    + [f"return_{k}h" for k in RETURN_WINDOWS]
    + ["return_momentum_24h", "return_momentum_72h", "return_acceleration"]
    + [f"trend_strength_{n}h" for n in REGIME_WINDOWS]
    + [f"range_vs_trend_{n}h" for n in REGIME_WINDOWS]
    + [f"volume_ma_{n}h" for n in VOLUME_WINDOWS]
    + [f"volume_ratio_{n}h" for n in VOLUME_WINDOWS]
    + [f"price_position_{n}h" for n in REGIME_WINDOWS]
    + ["hour", "hour_sin", "hour_cos", "day_of_week", "day_sin", "day_cos",
       "week_of_year", "week_sin", "week_cos", "is_weekend"]
)
TARGETS = [f"target_vol_{h}h" for h in FORWARD_HORIZONS]


def volatility_features(bars: DataFrame, keys: Sequence[str] = ("asset",), ts: str = "bar_ts",
                        chunk_rows: int | None = None, bucket: Column | None = None,
                        fit_on: Column | None = None, drop_undefined: bool = True) -> DataFrame:
    """The 41-feature hourly set plus forward-volatility targets,
    extreme flag and regime, per series.

    ``fit_on`` restricts the rows whose target quantiles define the flag
    and regime cut-offs (default: all rows of the series, as the source
    does). ``chunk_rows`` turns on halo chunking for very long series.
    """
    keys = list(keys)
    feats = ordered_select(bars, keys, [ts], [_level_returns, _level_features],
                           back=BACK, fwd=FWD, chunk_rows=chunk_rows, bucket=bucket)
    feats = feats.select("*", *calendar_features(ts)).drop("_hl2", "_tr")

    t24 = F.col("target_vol_24h")
    fit = t24 if fit_on is None else F.when(fit_on, t24)
    if chunk_rows is None:
        # series already sit in one partition each: the cut-offs are a
        # window over the same partitioning, no join and no extra shuffle
        w = Window.partitionBy(*keys)
        cut_cols = [F.percentile(fit, EXTREME_PERCENTILE).over(w).alias("_q_extreme"),
                    F.percentile(fit, 0.25).over(w).alias("_q25"),
                    F.percentile(fit, 0.75).over(w).alias("_q75"),
                    F.max(fit).over(w).alias("_qmax")]
        out = feats.select("*", *cut_cols)
    else:
        # long series are chunked: aggregate per series (partial aggregation
        # first), then join the one-row-per-series table back
        cuts = feats.groupBy(*keys).agg(
            F.percentile(fit, EXTREME_PERCENTILE).alias("_q_extreme"),
            F.percentile(fit, 0.25).alias("_q25"),
            F.percentile(fit, 0.75).alias("_q75"),
            F.max(fit).alias("_qmax"))
        out = feats.join(cuts, keys, "left")
    out = out.select(
        *[c for c in feats.columns],
        F.coalesce((t24 > F.col("_q_extreme")).cast("int"), F.lit(0)).alias("target_extreme_vol_flag"),
        regime_bins(t24, F.lit(0.0), F.col("_q25"), F.col("_q75"), F.col("_qmax")).alias("target_vol_regime"))
    if drop_undefined:
        out = out.dropna(subset=FEATURES + TARGETS)
    return out


def regime_bins(x: Column, b0: Column, b1: Column, b2: Column, b3: Column,
                labels: Sequence[str] = ("low_vol", "normal_vol", "high_vol")) -> Column:
    """Right-closed bins (b0,b1], (b1,b2], (b2,b3]; outside -> null."""
    return (F.when((x > b0) & (x <= b1), labels[0])
             .when((x > b1) & (x <= b2), labels[1])
             .when((x > b2) & (x <= b3), labels[2]))
