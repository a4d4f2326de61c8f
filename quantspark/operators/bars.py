"""Time bars and tick hygiene."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bar_start(ts: str | Column, width: str = "1 hour") -> Column:
    """Start of the tumbling bar containing ``ts`` (keeps TIMESTAMP_NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.window(c, width).start


def ohlcv_bars(ticks: DataFrame, keys: Sequence[str] = ("asset",), ts: str = "ts",
               price: str = "price", volume: str = "volume", tiebreak: str | None = "tick_id",
               width: str = "1 hour", out_ts: str = "bar_ts") -> DataFrame:
    """A1: first/max/min/last/sum per (series, bar); empty bars are absent.

    Grouping on (series, bar start) spreads even a hot series over all its
    bars, and min_by/max_by/max/min/sum all combine map-side before the
    shuffle, so only one partial row per (series, bar, task) moves.
    """
    order = F.struct(ts, tiebreak) if tiebreak else F.col(ts)
    return (ticks.groupBy(*keys, bar_start(ts, width).alias(out_ts))
                 .agg(F.min_by(price, order).alias("open"),
                      F.max(price).alias("high"),
                      F.min(price).alias("low"),
                      F.max_by(price, order).alias("close"),
                      F.sum(volume).alias("volume"),
                      F.count(F.lit(1)).alias("ticks")))


def last_per_bar(ticks: DataFrame, keys: Sequence[str], ts: str, value: str,
                 width: str = "1 hour", tiebreak: str | None = None, out_ts: str = "bar_ts") -> DataFrame:
    """A2: last value per bar (close-only resample)."""
    order = F.struct(ts, tiebreak) if tiebreak else F.col(ts)
    return (ticks.groupBy(*keys, bar_start(ts, width).alias(out_ts))
                 .agg(F.max_by(value, order).alias(value)))


def last_valid_per_period(df: DataFrame, keys: Sequence[str], period: Column, ts: str,
                          values: Sequence[str], period_name: str = "period") -> DataFrame:
    """Per (keys, period) the last non-null value of each column
    (pandas ``resample('ME').last()`` / ``groupby.last()``)."""
    aggs = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col(ts))).alias(v) for v in values]
    return df.groupBy(*keys, period.alias(period_name)).agg(*aggs)


def ohlc_audit(bars: DataFrame) -> DataFrame:
    """Flag bars whose OHLC relation is impossible; rows are kept."""
    bad = ((F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) |
           (F.col("high") < F.col("close")) | (F.col("low") > F.col("open")) |
           (F.col("low") > F.col("close")))
    return bars.withColumn("invalid_ohlc", F.coalesce(bad, F.lit(False)))


def drop_nonpositive(bars: DataFrame, cols: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """Drop rows with any price <= 0; null prices are kept (pandas
    compares NaN <= 0 as False)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.col(c) <= 0, F.lit(False))
    return bars.filter(~cond)
