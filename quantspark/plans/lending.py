"""Lending optimiser jobs on the hourly feature table.

States are the bars of the D1 feature set (realised 24 h volatility and
24 h volume ratio); trades are one request per asset and day, entered at
the day's first bar, 24 bars long, leverage 2/5/10/20 by weekday and
long/short by day parity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators import lending as L
from quantspark.operators import volatility as V
from quantspark.plans.common import round_doubles, sql_rnd, sql_round_select
from quantspark.plans.crypto import SQL_BARS, _d1_sql, hourly_bars
from quantspark.session import materialize

DURATION = 24
COLLATERAL = 1000.0
TRADE_LEVERAGE = (2.0, 5.0, 10.0, 20.0)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the published (rounded) D1 table, as the oracle reads it
    f = round_doubles(V.volatility_features(hourly_bars(spark, sf_dir)))
    return f.select("asset", "bar_ts", "close", "log_return", "realized_vol_24h", "volume_ratio_24h")


def optimal_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = L.revenue_grid(states(spark, sf_dir), ["asset", "bar_ts"], "realized_vol_24h", "volume_ratio_24h")
    return L.best_rate(g, ["asset", "bar_ts"])


def q_b1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: the full simulated grid."""
    g = L.revenue_grid(states(spark, sf_dir), ["asset", "bar_ts"], "realized_vol_24h", "volume_ratio_24h")
    return round_doubles(g.drop("vol", "volume_ratio"), 12)


def q_b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(optimal_rates(spark, sf_dir), 12)


def latest_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quoted rates of every leverage level at the latest bar of each asset."""
    s = materialize(states(spark, sf_dir))
    latest = s.groupBy("asset").agg(F.max("bar_ts").alias("bar_ts"))
    cur = latest.join(s, ["asset", "bar_ts"])
    # only the latest states need their best rate
    o = L.best_rate(L.revenue_grid(cur, ["asset", "bar_ts"], "realized_vol_24h", "volume_ratio_24h"), ["asset", "bar_ts"])
    cur = cur.join(o, ["asset", "bar_ts"])
    cur = cur.select("asset", "bar_ts", "realized_vol_24h", "optimal_rate_daily",
                     F.explode(F.array(*[F.lit(x) for x in L.LEVERAGE_LEVELS])).alias("leverage"))
    qv = L.quote(F.col("optimal_rate_daily"), F.col("realized_vol_24h"), F.col("leverage"))
    return cur.select("asset", "bar_ts", "leverage", F.col("optimal_rate_daily").alias("base_rate_daily"),
                      *[v.alias(k) for k, v in qv.items()])


def q_b5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + B3 + B4 + B6 + C10 + J16: rate table by leverage for the latest
    bar of each asset."""
    return round_doubles(latest_quotes(spark, sf_dir), 12)


def trade_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = states(spark, sf_dir)
    o = optimal_rates(spark, sf_dir)
    w = Window.partitionBy("asset").orderBy("bar_ts")
    bars = materialize(s.join(o, ["asset", "bar_ts"]).withColumn("pos", F.row_number().over(w)))
    n = bars.groupBy("asset").agg(F.max("pos").alias("_n"))
    day = F.to_date("bar_ts")
    first = bars.groupBy("asset", day.alias("day")).agg(F.min("pos").alias("entry_pos"))
    t = first.join(bars.withColumnRenamed("pos", "entry_pos"), ["asset", "entry_pos"]).join(n, "asset")
    t = t.filter(F.col("entry_pos") + DURATION <= F.col("_n"))
    lev = F.element_at(F.array(*[F.lit(x) for x in TRADE_LEVERAGE]), (F.weekday("day") % 4) + 1)
    is_long = F.dayofmonth("day") % 2 == 0
    qv = L.quote(F.col("optimal_rate_daily"), F.col("realized_vol_24h"), lev)
    size = F.lit(COLLATERAL) * lev
    mg = L.margin(lev, qv["predicted_volatility_24h"], F.col("close"), is_long, size)
    trades = t.select(F.concat_ws("|", "asset", F.date_format("day", "yyyy-MM-dd")).alias("trade_id"),
                      "asset", "entry_pos", F.col("bar_ts").alias("entry_ts"), F.col("close").alias("entry_price"),
                      is_long.alias("long"), lev.alias("leverage"), F.lit(COLLATERAL).alias("collateral"),
                      F.lit(DURATION).alias("duration"), qv["final_rate_hourly"].alias("rate_hourly"),
                      qv["predicted_volatility_24h"].alias("predicted_volatility"),
                      mg["mmr"].alias("mmr"), mg["liquidation_price_threshold"].alias("liquidation_price_threshold"),
                      mg["maintenance_margin"].alias("maintenance_margin"))
    return trades, bars


def q_b7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 + B8 + J13 + R6: path-dependent trade backtest."""
    trades, bars = trade_requests(spark, sf_dir)
    r = L.path_backtest(trades, bars, DURATION)
    return round_doubles(r.withColumn("path_rows", F.size("hourly_breakdown")).drop("hourly_breakdown"), 9)


def q_b9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome distribution of 24-bar holds per asset, leverage and side, at
    the rates quoted for the asset's latest bar."""
    bars = hourly_bars(spark, sf_dir)
    w = Window.partitionBy("asset").orderBy("bar_ts")
    bars = bars.withColumn("fwd_ret", F.lead("close", DURATION).over(w) / F.col("close") - 1)
    rates = latest_quotes(spark, sf_dir).select("asset", "leverage", F.col("final_rate_hourly").alias("rate_hourly"))
    return round_doubles(L.outcome_distribution(bars, rates, ["asset"], DURATION, COLLATERAL), 6, {"breakeven_price_change": 12})


# --- DuckDB oracles ---------------------------------------------------------

def _phi(x: str) -> str:
    z = f"(abs({x}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {z}))"
    poly = f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))"
    return f"(0.5 * (1.0 + sign({x}) * (1.0 - {poly} * exp(-{z} * {z}))))"


def _clip(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) < {lo} THEN {lo} WHEN ({x}) > {hi} THEN {hi} ELSE ({x}) END"


_RATES = ", ".join(repr(r) for r in L.test_rates())
_STATES = f"SELECT asset, bar_ts, close, log_return, realized_vol_24h, volume_ratio_24h FROM ({_d1_sql()}) d"


def _grid_sql() -> str:
    util = _clip(f"{L.BASE_DEMAND} * exp(-{L.ELASTICITY} * rate) * (1 + {L.VOL_FACTOR} * vol) * "
                 f"{_clip('volume_ratio', '0.5', '2.0')}", "0.1", "0.95")
    hold = _clip(f"{L.AVG_HOLD_HOURS} * (1 / (1 + 100 * rate)) * (1 / (1 + {L.SIM_LEVERAGE} * vol))", "1.0", "72.0")
    return f"""
WITH s AS ({_STATES}),
g AS (SELECT asset, bar_ts, realized_vol_24h AS vol, volume_ratio_24h AS volume_ratio,
             CAST(r.i - 1 AS INTEGER) AS rate_idx, r.rate
      FROM s, (SELECT unnest(range(1, {L.N_TEST_RATES + 1})) AS i, unnest([{_RATES}]) AS rate) r),
u AS (SELECT *, {util} AS utilization, {hold} AS hold_time FROM g),
p AS (SELECT *, vol / {repr(__import__('math').sqrt(L.HOURS_PER_YEAR))} * sqrt(hold_time) AS period_vol FROM u),
q AS (SELECT *, CASE WHEN period_vol < 1e-6 THEN 0.001
                 ELSE {_clip(f"2 * (1 - {_phi(f'(1.0 / {L.SIM_LEVERAGE}) / period_vol')})", '0.001', '0.5')} END AS liquidation_rate
      FROM p)
SELECT asset, bar_ts, rate_idx, rate, utilization, hold_time, liquidation_rate,
       rate * utilization * hold_time AS interest_revenue, {L.LIQUIDATION_FEE} * liquidation_rate * utilization AS liquidation_revenue,
       rate * utilization * hold_time + {L.LIQUIDATION_FEE} * liquidation_rate * utilization AS total_revenue
FROM q"""


SQL_GRID = _grid_sql()
_GRID_D = ["rate", "utilization", "hold_time", "liquidation_rate", "interest_revenue", "liquidation_revenue", "total_revenue"]
SQL_B1 = sql_round_select(SQL_GRID, ["asset", "bar_ts", "rate_idx"], _GRID_D, 12)
SQL_OPT = f"""SELECT asset, bar_ts, arg_max(rate, (total_revenue, -rate)) AS optimal_rate_hourly,
  max(total_revenue) AS expected_revenue, arg_max(rate, (total_revenue, -rate)) * 24 AS optimal_rate_daily
FROM ({SQL_GRID}) g GROUP BY 1, 2"""
SQL_B2 = sql_round_select(SQL_OPT, ["asset", "bar_ts"], ["optimal_rate_hourly", "expected_revenue", "optimal_rate_daily"], 12)


def _quote_sql(base: str, vol: str, lev: str) -> str:
    v = _clip(vol, "0.01", "5.0")
    prem = f"(pow({v}, 2) * pow({lev} / 10.0, {L.LEVERAGE_EXPONENT}) * 1.0 * {L.VOL_PREMIUM_SCALING})"
    final = _clip(f"{base} + {prem}", str(L.MIN_RATE_DAILY), str(L.MAX_RATE_DAILY))
    a, b, c = L.REGIME_CUTS
    reg = (f"CASE WHEN {v} < {a} THEN 'low_vol' WHEN {v} < {b} THEN 'normal_vol' "
           f"WHEN {v} < {c} THEN 'high_vol' ELSE 'extreme_vol' END")
    return (f"{v} AS predicted_volatility_24h, {prem} AS volatility_premium_daily, {final} AS final_rate_daily, "
            f"{final} * 365 AS final_rate_annualized, {final} / 24 AS final_rate_hourly, {reg} AS volatility_regime, "
            f"{final} * 0.9 AS rate_lower_80, {final} * 1.1 AS rate_upper_80, {v} * 0.85 AS vol_lower_80, "
            f"{v} * 1.15 AS vol_upper_80")


_LEVS = ", ".join(repr(x) for x in L.LEVERAGE_LEVELS)
SQL_QUOTES = f"""
WITH s AS ({_STATES}), o AS ({SQL_OPT}),
l AS (SELECT asset, max(bar_ts) AS bar_ts FROM s GROUP BY 1),
c AS (SELECT l.asset, l.bar_ts, s.realized_vol_24h, o.optimal_rate_daily, unnest([{_LEVS}]) AS leverage
      FROM l JOIN s USING (asset, bar_ts) JOIN o USING (asset, bar_ts))
SELECT asset, bar_ts, leverage, optimal_rate_daily AS base_rate_daily,
       {_quote_sql('optimal_rate_daily', 'realized_vol_24h', 'leverage')} FROM c"""
SQL_B5 = sql_round_select(SQL_QUOTES,
    ["asset", "bar_ts", "volatility_regime"],
    ["leverage", "base_rate_daily", "predicted_volatility_24h", "volatility_premium_daily", "final_rate_daily",
     "final_rate_annualized", "final_rate_hourly", "rate_lower_80", "rate_upper_80", "vol_lower_80", "vol_upper_80"], 12)


def _b7_sql() -> str:
    levs = ", ".join(repr(x) for x in TRADE_LEVERAGE)
    lev = f"list_extract([{levs}], CAST((isodow(day) - 1) % 4 + 1 AS INTEGER))"
    v = _clip("realized_vol_24h", "0.01", "5.0")
    prem = f"(pow({v}, 2) * pow(leverage / 10.0, {L.LEVERAGE_EXPONENT}) * 1.0 * {L.VOL_PREMIUM_SCALING})"
    final = _clip(f"optimal_rate_daily + {prem}", str(L.MIN_RATE_DAILY), str(L.MAX_RATE_DAILY))
    ann = repr(__import__('math').sqrt(L.HOURS_PER_YEAR))
    return f"""
WITH s AS ({_STATES}), o AS ({SQL_OPT}),
b AS (SELECT s.*, o.optimal_rate_daily, row_number() OVER (PARTITION BY s.asset ORDER BY s.bar_ts) AS pos
      FROM s JOIN o USING (asset, bar_ts)),
n AS (SELECT asset, max(pos) AS _n FROM b GROUP BY 1),
f AS (SELECT asset, CAST(bar_ts AS DATE) AS day, min(pos) AS entry_pos FROM b GROUP BY 1, 2),
t0 AS (SELECT f.day, f.entry_pos, b.*, {lev} AS leverage, dayofmonth(f.day) % 2 = 0 AS long
       FROM f JOIN b ON b.asset = f.asset AND b.pos = f.entry_pos JOIN n ON n.asset = f.asset
       WHERE f.entry_pos + {DURATION} <= n._n),
t AS (SELECT asset || '|' || strftime(day, '%Y-%m-%d') AS trade_id, asset, entry_pos, bar_ts AS entry_ts,
             close AS entry_price, long, leverage, {COLLATERAL} AS collateral, {DURATION} AS duration,
             {final} / 24 AS rate_hourly, {v} AS predicted_volatility,
             {L.BASE_MMR} + {v} * 0.02 + least(0.01 * (leverage / 10), 0.05) AS mmr
      FROM t0),
t2 AS (SELECT *, CASE WHEN long THEN entry_price * (1 - 1.0 / leverage + mmr) ELSE entry_price * (1 + 1.0 / leverage - mmr) END
                 AS liquidation_price_threshold, mmr * (collateral * leverage) AS maintenance_margin FROM t),
p AS (SELECT t2.trade_id, CAST(b.pos - t2.entry_pos AS INTEGER) AS hour, b.close AS price, b.log_return,
             CASE WHEN long THEN collateral * leverage * ((b.close - entry_price) / entry_price)
                  ELSE -(collateral * leverage) * ((b.close - entry_price) / entry_price) END AS pnl,
             rate_hourly * (collateral * leverage) * CAST(b.pos - t2.entry_pos AS INTEGER) AS interest,
             mmr * (collateral * leverage) AS mm
      FROM t2 JOIN b ON b.asset = t2.asset AND b.pos > t2.entry_pos AND b.pos <= t2.entry_pos + t2.duration),
p2 AS (SELECT *, collateral_eq <= mm AS breach FROM (
         SELECT p.*, t2.collateral + pnl - interest AS collateral_eq FROM p JOIN t2 USING (trade_id)) x),
fst AS (SELECT trade_id, min(hour) FILTER (WHERE breach) AS liquidation_hour,
               stddev_samp(log_return) * {ann} AS actual_volatility_realized FROM p2 GROUP BY 1),
k AS (SELECT p2.* FROM p2 JOIN fst USING (trade_id) WHERE liquidation_hour IS NULL OR hour <= liquidation_hour),
pa AS (SELECT trade_id, count(*) AS path_rows, max(interest) AS interest_charged, arg_max(price, hour) AS last_price
       FROM k GROUP BY 1)
SELECT t2.*, fst.liquidation_hour, fst.actual_volatility_realized, pa.interest_charged, pa.path_rows,
  fst.liquidation_hour IS NOT NULL AS liquidated,
  CASE WHEN fst.liquidation_hour IS NOT NULL THEN pa.last_price END AS liquidation_price,
  pa.last_price AS exit_price,
  CASE WHEN fst.liquidation_hour IS NOT NULL THEN -collateral
       ELSE (CASE WHEN long THEN collateral * leverage * ((pa.last_price - entry_price) / entry_price)
                  ELSE -(collateral * leverage) * ((pa.last_price - entry_price) / entry_price) END) - pa.interest_charged END
    AS trader_pnl,
  pa.interest_charged + CASE WHEN fst.liquidation_hour IS NOT NULL THEN {L.LIQUIDATION_FEE} * (collateral * leverage) ELSE 0.0 END
    AS lender_revenue,
  CASE WHEN fst.liquidation_hour IS NOT NULL THEN {L.LIQUIDATION_FEE} * (collateral * leverage) ELSE 0.0 END AS liquidation_fee
FROM t2 JOIN fst USING (trade_id) JOIN pa USING (trade_id)"""


SQL_B7 = sql_round_select(_b7_sql(),
    ["trade_id", "asset", "entry_pos", "entry_ts", "long", "duration", "liquidation_hour", "liquidated", "path_rows"],
    ["entry_price", "leverage", "collateral", "rate_hourly", "predicted_volatility", "mmr",
     "liquidation_price_threshold", "maintenance_margin", "actual_volatility_realized", "interest_charged",
     "liquidation_price", "exit_price", "trader_pnl", "lender_revenue", "liquidation_fee"], 9)

SQL_B9 = sql_round_select(f"""
WITH b AS ({SQL_BARS}), r AS ({SQL_QUOTES}),
f AS (SELECT asset, lead(close, {DURATION}) OVER (PARTITION BY asset ORDER BY bar_ts) / close - 1 AS fwd_ret FROM b),
d AS (SELECT f.asset, leverage, final_rate_hourly AS rate, unnest(['long', 'short']) AS position, fwd_ret
      FROM f JOIN r USING (asset) WHERE fwd_ret IS NOT NULL),
x AS (SELECT *, CASE position WHEN 'long' THEN fwd_ret ELSE -fwd_ret END AS away FROM d),
e AS (SELECT *, away <= -(1.0 / leverage) AS liq, CASE WHEN away <= -(1.0 / leverage) THEN -{COLLATERAL}
             ELSE leverage * {COLLATERAL} * away - rate * {DURATION} * (leverage * {COLLATERAL}) END AS pnl FROM x)
SELECT asset, leverage, position, count(*) AS paths, avg(CAST(liq AS DOUBLE)) AS liquidation_probability, avg(pnl) AS expected_pnl,
  quantile_cont(pnl, 0.05) AS pnl_p5, quantile_cont(pnl, 0.25) AS pnl_p25, quantile_cont(pnl, 0.5) AS pnl_p50,
  quantile_cont(pnl, 0.75) AS pnl_p75, quantile_cont(pnl, 0.95) AS pnl_p95,
  max(rate * {DURATION} * (leverage * {COLLATERAL})) AS total_interest_expected, max(rate * {DURATION}) AS breakeven_price_change
FROM e GROUP BY 1, 2, 3""", ["asset", "position", "paths"],
    ["leverage", "liquidation_probability", "expected_pnl", "pnl_p5", "pnl_p25", "pnl_p50", "pnl_p75", "pnl_p95",
     "total_interest_expected", "breakeven_price_change"], 6, {"breakeven_price_change": 12})

QUERIES = {"b1": q_b1, "b2": q_b2, "b5": q_b5, "b7": q_b7, "b9": q_b9}
ORACLE = {"b1": SQL_B1, "b2": SQL_B2, "b5": SQL_B5, "b7": SQL_B7, "b9": SQL_B9}
