"""Lending-rate grid, quotes, margin maths and path backtests.

The rate grid and the leverage table are generators (``explode`` over a
literal array) on each state row, not joins. The trade path is an
equi-join on (asset, position bucket) plus a residual range predicate; the
first margin breach is an aggregate, later rows are cut by a filter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.functions.numeric import clip, normal_cdf

# Fixed simulation and pricing parameters of the reference configuration.
BASE_DEMAND = 0.8
ELASTICITY = 20.0
VOL_FACTOR = 1.0
AVG_HOLD_HOURS = 8.0
LIQUIDATION_FEE = 0.05
MIN_TEST_RATE_DAILY = 0.0001
MAX_TEST_RATE_DAILY = 0.0025
N_TEST_RATES = 50
SIM_LEVERAGE = 5.0
MIN_RATE_DAILY = 0.0001
MAX_RATE_DAILY = 0.01
VOL_PREMIUM_SCALING = 0.001
LEVERAGE_EXPONENT = 0.7
LEVERAGE_LEVELS = (2.0, 5.0, 10.0, 20.0, 50.0, 100.0)
REGIME_CUTS = (0.3, 0.7, 1.5)
REGIME_LABELS = ("low_vol", "normal_vol", "high_vol", "extreme_vol")
BASE_MMR = 0.025
HOURS_PER_YEAR = 365 * 24


def test_rates(n: int = N_TEST_RATES) -> list[float]:
    """Hourly candidate rates, evenly spaced like ``numpy.linspace`` (last
    point exactly the upper bound)."""
    lo, hi = MIN_TEST_RATE_DAILY / 24, MAX_TEST_RATE_DAILY / 24
    step = (hi - lo) / (n - 1)
    return [lo + i * step for i in range(n - 1)] + [hi]


def simulate(rate: Column, vol: Column, volume_ratio: Column, leverage: float = SIM_LEVERAGE) -> dict[str, Column]:
    """B1: utilisation, hold time, liquidation probability and revenue."""
    util = clip(BASE_DEMAND * F.exp(-ELASTICITY * rate) * (1 + VOL_FACTOR * vol) * clip(volume_ratio, 0.5, 2.0),
                0.1, 0.95)
    hold = clip(AVG_HOLD_HOURS * (1 / (1 + 100 * rate)) * (1 / (1 + leverage * vol)), 1.0, 72.0)
    period_vol = vol / math.sqrt(HOURS_PER_YEAR) * F.sqrt(hold)
    liq = F.when(period_vol < 1e-6, F.lit(0.001)).otherwise(
        clip(2 * (1 - normal_cdf((1.0 / leverage) / period_vol)), 0.001, 0.5))
    interest = rate * util * hold
    liq_rev = LIQUIDATION_FEE * liq * util
    return {"utilization": util, "hold_time": hold, "liquidation_rate": liq,
            "interest_revenue": interest, "liquidation_revenue": liq_rev, "total_revenue": interest + liq_rev}


def revenue_grid(states: DataFrame, keys: Sequence[str], vol: str, volume_ratio: str) -> DataFrame:
    """B1 + J15: every state x every candidate rate.

    The simulation is staged over successive projections: utilisation and
    hold time, then the period volatility, then the CDF argument, so that
    each intermediate is computed once per row instead of being inlined into
    every expression that uses it (nested clips and the CDF polynomial would
    otherwise repeat whole subtrees in generated code)."""
    rates = F.array(*[F.lit(r) for r in test_rates()])
    g = states.select(*keys, F.col(vol).alias("vol"), F.col(volume_ratio).alias("volume_ratio"),
                      F.posexplode(rates).alias("rate_idx", "rate"))
    sim = simulate(F.col("rate"), F.col("vol"), F.col("volume_ratio"))
    g = g.select("*", sim["utilization"].alias("utilization"), sim["hold_time"].alias("hold_time"))
    g = g.select("*", (F.col("vol") / math.sqrt(HOURS_PER_YEAR) * F.sqrt("hold_time")).alias("_pv"))
    g = g.select("*", ((1.0 / SIM_LEVERAGE) / F.col("_pv")).alias("_z"))
    g = g.select("*", normal_cdf(F.col("_z")).alias("_cdf"))
    liq = F.when(F.col("_pv") < 1e-6, F.lit(0.001)).otherwise(clip(2 * (1 - F.col("_cdf")), 0.001, 0.5))
    g = g.select("*", liq.alias("liquidation_rate"))
    interest = F.col("rate") * F.col("utilization") * F.col("hold_time")
    liq_rev = LIQUIDATION_FEE * F.col("liquidation_rate") * F.col("utilization")
    g = g.select("*", interest.alias("interest_revenue"), liq_rev.alias("liquidation_revenue"))
    g = g.withColumn("total_revenue", F.col("interest_revenue") + F.col("liquidation_revenue"))
    return g.drop("_pv", "_z", "_cdf")


def best_rate(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """B2 + K4: argmax revenue per state; ties go to the lowest rate."""
    return grid.groupBy(*keys).agg(
        F.max_by("rate", F.struct(F.col("total_revenue"), -F.col("rate"))).alias("optimal_rate_hourly"),
        F.max("total_revenue").alias("expected_revenue")
    ).withColumn("optimal_rate_daily", F.col("optimal_rate_hourly") * 24)


def regime(vol: Column) -> Column:
    """Fixed cut-offs."""
    a, b, c = REGIME_CUTS
    return (F.when(vol < a, REGIME_LABELS[0]).when(vol < b, REGIME_LABELS[1])
             .when(vol < c, REGIME_LABELS[2]).otherwise(REGIME_LABELS[3]))


def quote(base_rate_daily: Column, predicted_vol: Column, leverage: Column, beta: float = 1.0) -> dict[str, Column]:
    """B3 + B4: volatility premium, clipped final rate, unit conversions and
    the +-10% rate / +-15% volatility bands."""
    vol = clip(predicted_vol, 0.01, 5.0)
    premium = F.pow(vol, 2) * F.pow(leverage / 10.0, LEVERAGE_EXPONENT) * beta * VOL_PREMIUM_SCALING
    final = clip(base_rate_daily + premium, MIN_RATE_DAILY, MAX_RATE_DAILY)
    return {"predicted_volatility_24h": vol, "volatility_premium_daily": premium,
            "final_rate_daily": final, "final_rate_annualized": final * 365, "final_rate_hourly": final / 24,
            "volatility_regime": regime(vol),
            "rate_lower_80": final * 0.9, "rate_upper_80": final * 1.1,
            "vol_lower_80": vol * 0.85, "vol_upper_80": vol * 1.15}


def margin(leverage: Column, predicted_vol: Column, entry_price: Column, long: Column,
           position_size: Column) -> dict[str, Column]:
    """Initial / maintenance margin rates, theoretical liquidation
    price, maintenance margin and liquidation fee."""
    imr = 1.0 / leverage
    mmr = BASE_MMR + predicted_vol * 0.02 + F.least(0.01 * (leverage / 10), F.lit(0.05))
    liq_px = F.when(long, entry_price * (1 - imr + mmr)).otherwise(entry_price * (1 + imr - mmr))
    return {"imr": imr, "mmr": mmr, "liquidation_price_threshold": liq_px,
            "maintenance_margin": mmr * position_size, "liquidation_fee_amount": LIQUIDATION_FEE * position_size}


def path_backtest(trades: DataFrame, bars: DataFrame, max_hours: int) -> DataFrame:
    """Hour-by-hour equity of each trade over the next ``duration``
    bars (row positions), interest accrual, first breach of maintenance
    margin (``<=``), rows after the breach cut, realised volatility.

    ``trades``: trade_id, asset, entry_pos, entry_price, long, leverage,
    collateral, duration, rate_hourly, mmr.  ``bars``: asset, pos, bar_ts,
    close, log_return. Path rows come from an equi-join on (asset, bucket)
    with buckets of ``max_hours`` positions, so each trade meets at most
    two buckets of bars.
    """
    h = max_hours
    t = trades.select("*", F.explode(F.array(F.floor(F.col("entry_pos") / h),
                                             F.floor(F.col("entry_pos") / h) + 1)).alias("_b"))
    b = bars.select("asset", "pos", "bar_ts", "close", "log_return", F.floor(F.col("pos") / h).alias("_b"))
    p = t.join(b, ["asset", "_b"]).filter((F.col("pos") > F.col("entry_pos")) &
                                          (F.col("pos") <= F.col("entry_pos") + F.col("duration")))
    size = F.col("collateral") * F.col("leverage")
    hour = (F.col("pos") - F.col("entry_pos")).cast("int")
    move = (F.col("close") - F.col("entry_price")) / F.col("entry_price")
    pnl = F.when(F.col("long"), size * move).otherwise(-size * move)
    interest = F.col("rate_hourly") * size * hour
    p = p.select("trade_id", hour.alias("hour"), "bar_ts", F.col("close").alias("price"), "log_return",
                 pnl.alias("unrealized_pnl"), interest.alias("interest_paid"),
                 (F.col("collateral") + pnl - interest).alias("equity"),
                 (F.col("mmr") * size).alias("_mm"))
    p = p.withColumn("_breach", F.col("equity") <= F.col("_mm"))
    first = p.groupBy("trade_id").agg(
        F.min(F.when(F.col("_breach"), F.col("hour"))).alias("liquidation_hour"),
        (F.stddev_samp("log_return") * math.sqrt(HOURS_PER_YEAR)).alias("actual_volatility_realized"),
        F.max("hour").alias("_last_hour"))
    kept = p.join(first, "trade_id").filter(F.col("liquidation_hour").isNull() | (F.col("hour") <= F.col("liquidation_hour")))
    path = kept.groupBy("trade_id").agg(
        F.sort_array(F.collect_list(F.struct("hour", "bar_ts", "price", "equity", "unrealized_pnl", "interest_paid",
                                             F.col("_breach").alias("liquidated")))).alias("hourly_breakdown"),
        F.max("interest_paid").alias("interest_charged"),
        F.max_by("price", "hour").alias("last_price"))
    out = trades.join(first, "trade_id").join(path, "trade_id")
    liquidated = F.col("liquidation_hour").isNotNull()
    size_t = F.col("collateral") * F.col("leverage")
    exit_move = (F.col("last_price") - F.col("entry_price")) / F.col("entry_price")
    price_pnl = F.when(F.col("long"), size_t * exit_move).otherwise(-size_t * exit_move)
    fee = F.when(liquidated, LIQUIDATION_FEE * size_t).otherwise(0.0)
    return out.select(
        "*", liquidated.alias("liquidated"),
        F.when(liquidated, F.col("last_price")).alias("liquidation_price"),
        F.col("last_price").alias("exit_price"),
        F.when(liquidated, -F.col("collateral")).otherwise(price_pnl - F.col("interest_charged")).alias("trader_pnl"),
        (F.col("interest_charged") + fee).alias("lender_revenue"), fee.alias("liquidation_fee")
    ).drop("last_price", "_last_hour")


def outcome_distribution(bars: DataFrame, rates: DataFrame, keys: Sequence[str], horizon: int,
                         collateral: float = 1000.0, parity: bool = False) -> DataFrame:
    """B9 (re-aimed from random paths): the empirical ``horizon``-bar returns of
    the history give, per (keys, leverage) of ``rates`` and per side, the
    liquidation probability, P&L percentiles, expected interest and the price
    change that pays it. ``bars`` must carry ``fwd_ret``; ``rates`` the keys,
    ``leverage`` and ``rate_hourly``.

    A short earns the negative return. parity=True reproduces the literal
    behaviour, where the surviving paths of a short earn the return itself."""
    sides = F.explode(F.array(F.lit("long"), F.lit("short"))).alias("position")
    d = bars.filter(F.col("fwd_ret").isNotNull()).select(*keys, "fwd_ret").join(rates, list(keys)).select("*", sides)
    size, short = F.col("leverage") * collateral, F.col("position") == "short"
    interest = F.col("rate_hourly") * horizon * size
    away = F.when(short, -F.col("fwd_ret")).otherwise(F.col("fwd_ret"))
    earned = F.col("fwd_ret") if parity else away
    liq = away <= -(1.0 / F.col("leverage"))
    d = d.withColumn("pnl", F.when(liq, F.lit(-collateral)).otherwise(size * earned - interest)).withColumn("liq", liq)
    qs = [0.05, 0.25, 0.5, 0.75, 0.95]
    return d.groupBy(*keys, "leverage", "position").agg(
        F.count(F.lit(1)).alias("paths"), F.avg(F.col("liq").cast("double")).alias("liquidation_probability"),
        F.avg("pnl").alias("expected_pnl"), *[F.percentile("pnl", q).alias(f"pnl_p{int(q * 100)}") for q in qs],
        F.max(interest).alias("total_interest_expected"),
        F.max(F.col("rate_hourly") * horizon).alias("breakeven_price_change"))
