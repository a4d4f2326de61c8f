"""Bars and volatility features on the tick view of ``events``."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators import bars as B
from quantspark.operators import volatility as V
from quantspark.plans.common import round_doubles, sql_round_select, sql_roll
from quantspark.sources.tables import ticks


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.ohlcv_bars(ticks(spark, sf_dir))


def q_a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + P14 + P15: hourly OHLCV bars per asset, audited."""
    bars = B.drop_nonpositive(B.ohlc_audit(hourly_bars(spark, sf_dir)))
    return round_doubles(bars)


def q_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """41 hourly features + targets per asset, undefined rows trimmed."""
    feats = V.volatility_features(hourly_bars(spark, sf_dir))
    return round_doubles(feats)


def q_d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar encodings of each bar."""
    bars = hourly_bars(spark, sf_dir)
    return round_doubles(bars.select("asset", "bar_ts", *V.calendar_features("bar_ts")))


# --- DuckDB oracles ---------------------------------------------------------

SQL_BARS = """
SELECT event_type AS asset, date_trunc('hour', ts) AS bar_ts,
       arg_min(value + 1.0, (ts, event_id)) AS open, max(value + 1.0) AS high,
       min(value + 1.0) AS low, arg_max(value + 1.0, (ts, event_id)) AS close,
       sum(1.0) AS volume, count(*) AS ticks
FROM events GROUP BY 1, 2
"""

BAR_DOUBLES = ["open", "high", "low", "close", "volume"]

SQL_A1 = sql_round_select(f"""
SELECT *, coalesce(high < low OR high < open OR high < close OR low > open OR low > close, false)
          AS invalid_ohlc
FROM ({SQL_BARS}) b
WHERE NOT (coalesce(open <= 0, false) OR coalesce(high <= 0, false)
           OR coalesce(low <= 0, false) OR coalesce(close <= 0, false))
""", ["asset", "bar_ts", "ticks", "invalid_ohlc"], BAR_DOUBLES)

_ANN = repr(math.sqrt(365 * 24))
_PK = repr(4 * math.log(2))


def _calendar_sql(ts: str = "bar_ts") -> str:
    return f"""
  CAST(hour({ts}) AS INTEGER) AS hour,
  sin(2 * pi() * hour({ts}) / 24) AS hour_sin, cos(2 * pi() * hour({ts}) / 24) AS hour_cos,
  CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
  sin(2 * pi() * (isodow({ts}) - 1) / 7) AS day_sin, cos(2 * pi() * (isodow({ts}) - 1) / 7) AS day_cos,
  CAST(week({ts}) AS INTEGER) AS week_of_year,
  sin(2 * pi() * week({ts}) / 52) AS week_sin, cos(2 * pi() * week({ts}) / 52) AS week_cos,
  CAST(isodow({ts}) >= 6 AS INTEGER) AS is_weekend"""


def _d1_sql() -> str:
    p, o = "asset", "bar_ts"

    def roll(agg, c, n):
        return sql_roll(agg, c, n, p, o)

    lvl1 = f"""
SELECT *,
  CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS log_return,
  pow(CASE WHEN high / low > 0 THEN ln(high / low) END, 2) AS _hl2,
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS _tr,
  {', '.join(f'close / lag(close, {k}) OVER w - 1 AS return_{k}h' for k in V.RETURN_WINDOWS)}
FROM ({SQL_BARS}) b
WINDOW w AS (PARTITION BY {p} ORDER BY {o})"""
    f = []
    for n in V.VOLATILITY_WINDOWS:
        f.append(f"{roll('stddev_samp', 'log_return', n)} * {_ANN} AS realized_vol_{n}h")
        f.append(f"sqrt({roll('avg', '_hl2', n)} / {_PK}) * {_ANN} AS parkinson_vol_{n}h")
    for n in V.VOLATILITY_WINDOWS:
        f.append(f"{roll('stddev_samp', 'volume', n)} / ({roll('avg', 'volume', n)} + 1e-10) AS volume_volatility_{n}h")
    f.append(f"{roll('sum', 'log_return', 24)} AS return_momentum_24h")
    f.append(f"{roll('sum', 'log_return', 72)} AS return_momentum_72h")
    f.append(f"return_24h - lag(return_24h, 24) OVER w AS return_acceleration")
    for n in V.REGIME_WINDOWS:
        f.append(f"{roll('avg', '_tr', n)} / (close + 1e-10) AS trend_strength_{n}h")
    for n in V.REGIME_WINDOWS:
        f.append(f"({roll('max', 'high', n)} - {roll('min', 'low', n)}) / "
                 f"({roll('stddev_samp', 'close', n)} * {repr(math.sqrt(n))} + 1e-10) AS range_vs_trend_{n}h")
    for n in V.VOLUME_WINDOWS:
        f.append(f"{roll('avg', 'volume', n)} AS volume_ma_{n}h")
        f.append(f"volume / ({roll('avg', 'volume', n)} + 1e-10) AS volume_ratio_{n}h")
    for n in V.REGIME_WINDOWS:
        f.append(f"(close - {roll('min', 'low', n)}) / ({roll('max', 'high', n)} - {roll('min', 'low', n)} + 1e-10)"
                 f" AS price_position_{n}h")
    f.append(f"abs(CASE WHEN lead(close) OVER w / close > 0 THEN ln(lead(close) OVER w / close) END) * {_ANN}"
             f" AS target_vol_1h")
    for h in V.FORWARD_HORIZONS[1:]:
        f.append(f"stddev_samp(log_return) OVER (PARTITION BY {p} ORDER BY {o} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING)"
                 f" * {_ANN} AS target_vol_{h}h")
    lvl2 = f"""
SELECT *, {', '.join(f)}, {_calendar_sql()}
FROM ({lvl1}) l1
WINDOW w AS (PARTITION BY {p} ORDER BY {o})"""
    cuts = f"""
SELECT asset, quantile_cont(target_vol_24h, {V.EXTREME_PERCENTILE}) AS _q_extreme,
       quantile_cont(target_vol_24h, 0.25) AS _q25, quantile_cont(target_vol_24h, 0.75) AS _q75,
       max(target_vol_24h) AS _qmax
FROM ({lvl2}) l2 GROUP BY asset"""
    cond = " AND ".join(f"{c} IS NOT NULL" for c in V.FEATURES + V.TARGETS)
    final = f"""
SELECT l2.* EXCLUDE (_hl2, _tr),
  CAST(coalesce(target_vol_24h > _q_extreme, false) AS INTEGER) AS target_extreme_vol_flag,
  CASE WHEN target_vol_24h > 0 AND target_vol_24h <= _q25 THEN 'low_vol'
       WHEN target_vol_24h > _q25 AND target_vol_24h <= _q75 THEN 'normal_vol'
       WHEN target_vol_24h > _q75 AND target_vol_24h <= _qmax THEN 'high_vol' END AS target_vol_regime
FROM ({lvl2}) l2 LEFT JOIN ({cuts}) c USING (asset)
WHERE {cond}"""
    ints = ["hour", "day_of_week", "week_of_year", "is_weekend"]
    doubles = (BAR_DOUBLES + ["log_return"]
               + [c for c in V.FEATURES if c not in ints] + V.TARGETS)
    plain = ["asset", "bar_ts", "ticks"] + ints + ["target_extreme_vol_flag", "target_vol_regime"]
    return sql_round_select(final, plain, doubles)


SQL_D2 = sql_round_select(f"SELECT asset, bar_ts, {_calendar_sql()} FROM ({SQL_BARS}) b",
                          ["asset", "bar_ts", "hour", "day_of_week", "week_of_year", "is_weekend"],
                          ["hour_sin", "hour_cos", "day_sin", "day_cos", "week_sin", "week_cos"])

QUERIES = {"a1": q_a1, "d1": q_d1, "d2": q_d2}
ORACLE = {"a1": SQL_A1, "d1": _d1_sql(), "d2": SQL_D2}
