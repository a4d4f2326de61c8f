"""Hand-made fixtures for the semantics traps of the source (one per trap)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantspark.functions import clean as C
from quantspark.functions.numeric import normal_cdf, qcut_of_rank
from quantspark.operators import backtest as BT
from quantspark.operators import events as EV
from quantspark.operators.evaluation import roc_auc
from quantspark.operators.ordered import rolling
from quantspark.operators.stats import global_quantiles, vif_elimination


def test_qcut_of_rank_differs_from_ntile(spark):
    df = spark.createDataFrame([(r, 7) for r in range(1, 8)], "r int, n int")
    got = [x.g for x in df.select(qcut_of_rank("r", "n").alias("g")).orderBy("r").collect()]
    assert got == [0, 0, 1, 2, 3, 4, 4]
    for n in range(2, 60):
        ranks = pd.Series(range(1, n + 1))
        expect = pd.qcut(ranks, 5, labels=False, duplicates="drop").tolist()
        d = spark.createDataFrame([(r, n) for r in range(1, n + 1)], "r int, n int")
        assert [x.g for x in d.select(qcut_of_rank("r", "n").alias("g")).orderBy("r").collect()] == expect, n


def test_rolling_guard(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0), (5, 5.0)], "i int, v double")
    w = Window.orderBy("i")
    got = [r.m for r in df.select("i", rolling(F.avg, "v", w, 3).alias("m")).orderBy("i").collect()]
    expect = pd.Series([1.0, None, 3.0, 4.0, 5.0]).rolling(3).mean().tolist()
    assert [None if (x is None or (isinstance(x, float) and math.isnan(x))) else x for x in expect] == got


def test_money_text_variants(spark):
    vals = ["$1,234.50", "(5)", "+10%", "New", ">999%", "-", ""]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    r = df.select(C.money("s").alias("a"), C.money_loose("s").alias("b"), C.percent_fraction("s").alias("c")).collect()
    assert [x.a for x in r] == [1234.5, -5.0, None, None, None, None, None]
    assert [x.b for x in r] == [1234.5, None, 10.0, None, 999.0, None, None]
    assert [x.c for x in r][2] == 0.1


def test_seven_day_cluster(spark):
    rows = [(1, "T", "a", 0), (2, "T", "b", 0), (3, "T", "c", 3), (4, "T", "d", 7), (5, "T", "e", 8)]
    df = spark.createDataFrame(rows, "id int, ticker string, owner string, day int")
    got = {r.id: r.c for r in EV.trailing_distinct(df, ["ticker"], "day", "owner", 7, "c").collect()}
    # day 7 sees days 0..6 (a, b, c); day 8 sees days 1..7 (c, d)
    assert got == {1: 0, 2: 0, 3: 2, 4: 3, 5: 2}
    cnt = {r.id: r.n for r in EV.trailing_count(df, ["ticker"], "day", 30, "n").collect()}
    assert cnt == {1: 0, 2: 0, 3: 2, 4: 3, 5: 4}


def _brute_cash(trades, parity, start=10000.0):
    """Per-trade event loop in the style of the source (intent or literal)."""
    t = [x for x in trades if x["entry_date"] is not None and x["exit_date"] is not None]
    dates = sorted({x["entry_date"] for x in t} | {x["exit_date"] for x in t})
    cash, pos, logs = start, [], []
    for d in dates:
        keep = []
        for p in pos:
            if p[0] <= d:
                cash += p[1] * p[2]
            else:
                keep.append(p)
        pos = keep
        today = [x for x in t if x["entry_date"] == d]
        if today and cash > 0:
            valid = [x for x in today if (x["long_return"] if x["signal"] == 1 else x["short_return"]) is not None]
            n_new = len(today) if parity else len(valid)
            if n_new:
                per = cash / n_new
                for x in valid:
                    r = x["long_return"] if x["signal"] == 1 else x["short_return"]
                    g = 1 + (x["signal"] * r if parity else r)
                    pos.append((x["exit_date"], per, g))
                cash -= per * n_new
        pv = sum(p[1] for p in pos)
        logs.append((d, round(cash, 9), round(pv, 9), len(pos)))
    return logs


def test_cash_recycling_matches_brute_force(spark):
    d = dt.date
    trades = [
        {"horizon": 1, "entry_date": d(2024, 1, 2), "exit_date": d(2024, 1, 4), "signal": 1, "long_return": 0.1, "short_return": -0.1},
        {"horizon": 1, "entry_date": d(2024, 1, 2), "exit_date": d(2024, 1, 3), "signal": -1, "long_return": 0.05, "short_return": -0.05},
        {"horizon": 1, "entry_date": d(2024, 1, 3), "exit_date": d(2024, 1, 5), "signal": 1, "long_return": None, "short_return": None},
        {"horizon": 1, "entry_date": d(2024, 1, 3), "exit_date": d(2024, 1, 6), "signal": 1, "long_return": -0.2, "short_return": 0.2},
        {"horizon": 1, "entry_date": d(2024, 1, 5), "exit_date": d(2024, 1, 5), "signal": -1, "long_return": 0.3, "short_return": -0.3},
    ]
    df = spark.createDataFrame(pd.DataFrame(trades))
    for parity in (False, True):
        got = BT.cash_recycling(df, ["horizon"], parity=parity).orderBy("date").collect()
        got = [(r.date, round(r.cash, 9), round(r.positions_value, 9), r.open_positions) for r in got]
        assert got == _brute_cash(trades, parity), parity


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, s double").withColumn("g", F.lit(1))
    auc = roc_auc(df, ["g"], "y", "s").first().roc_auc
    assert auc == 0.875


def test_vif_drops_proportional_first(spark):
    rows = [(float(i), 2.0 * i, float((i * 7) % 5 + 1)) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    kept, removed = vif_elimination(df, ["a", "b", "c"])
    assert removed and removed[0][0] in ("a", "b")
    assert "c" in kept


def test_global_quantiles_exact(spark):
    vals = [float((i * 7919) % 1000) / 7 for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    import quantspark.operators.stats as S
    old = S.FINAL_CANDIDATES
    S.FINAL_CANDIDATES = 50          # force the histogram rounds
    try:
        got = global_quantiles(df, "x", [0.0, 0.2, 0.5, 0.995, 1.0])
    finally:
        S.FINAL_CANDIDATES = old
    expect = np.quantile(np.array(vals), [0.0, 0.2, 0.5, 0.995, 1.0]).tolist()
    assert np.allclose(got, expect, rtol=0, atol=1e-12)


def test_normal_cdf(spark):
    df = spark.createDataFrame([(x,) for x in (-3.0, -1.0, 0.0, 0.5, 2.0)], "x double")
    got = [r.p for r in df.select(normal_cdf("x").alias("p")).collect()]
    expect = [0.5 * (1 + math.erf(x / math.sqrt(2))) for x in (-3.0, -1.0, 0.0, 0.5, 2.0)]
    assert max(abs(a - b) for a, b in zip(got, expect)) < 2e-7


def test_liquidation_breach_cuts_path(spark):
    from quantspark.operators.lending import path_backtest
    base = dt.datetime(2024, 1, 1)
    closes = [100.0, 99.0, 90.0, 95.0, 120.0]
    bars = spark.createDataFrame([("A", i + 1, base + dt.timedelta(hours=i), c, None) for i, c in enumerate(closes)],
                                 "asset string, pos int, bar_ts timestamp_ntz, close double, log_return double")
    # long 10x, collateral 100: equity = 100 + 1000 * move; mm = 0.1 * 1000 = 100 -> breach at the first move <= 0
    trades = spark.createDataFrame([("t", "A", 1, 100.0, True, 10.0, 100.0, 4, 0.0, 0.1)],
                                   "trade_id string, asset string, entry_pos int, entry_price double, long boolean, "
                                   "leverage double, collateral double, duration int, rate_hourly double, mmr double")
    r = path_backtest(trades, bars, 4).first()
    assert r.liquidated and r.liquidation_hour == 1 and len(r.hourly_breakdown) == 1
    assert r.trader_pnl == -100.0
