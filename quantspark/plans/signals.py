"""Signal backtests on the tick view of ``events``.

Every event is a signal for its event type (ticker) on its day; the three
predictions are affine in the event value. Daily prices are the first/last
tick of each (type, day). Horizons are 1, 3 and 7 days because the table
spans one month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators import backtest as BT
from quantspark.operators.ordered import day_number, ordered_select
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.session import materialize
from quantspark.sources.tables import daily_prices, table

HORIZONS = (1, 3, 7)
PRED_SHIFT = {1: 40.0, 3: 50.0, 7: 60.0}
BENCH_ROWS = 21


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    preds = {h: f"pred_{h}d" for h in HORIZONS}
    s = ev.select(F.col("event_id").alias("signal_id"), F.col("event_type").alias("ticker"),
                  F.to_date("ts").alias("transaction_date"),
                  *[((F.col("value") - PRED_SHIFT[h]) / 100).alias(preds[h]) for h in HORIZONS])
    return BT.unpivot_horizons(s, preds, ["signal_id", "ticker", "transaction_date"])


def realised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BT.signal_returns(signals(spark, sf_dir), daily_prices(spark, sf_dir))


def q_b10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(realised(spark, sf_dir))


def q_b11(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = materialize(realised(spark, sf_dir))
    return round_doubles(BT.cash_recycling(trades, ["horizon"]))


def q_b13(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = materialize(realised(spark, sf_dir))
    logs = BT.cash_recycling(trades, ["horizon"])
    return round_doubles(BT.merge_equity_logs(logs, HORIZONS))


def _fixed_stake(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = realised(spark, sf_dir).filter(F.col("entry_date").isNotNull()).withColumn("signal", (F.col("signal") == 1).cast("int"))
    return BT.fixed_stake_equity(t, ["horizon"], ["entry_date", "signal_id"], "long_return", "signal",
                                 bucket=day_number("entry_date"))


def q_b14_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 on a fixed-stake ledger of long signals per horizon, rebased to 10,000."""
    eq = materialize(_fixed_stake(spark, sf_dir))
    eq = eq.withColumn("_o", F.struct("entry_date", "signal_id"))
    out = BT.rebase(eq, ["horizon"], "_o", "equity").drop("_o")
    return round_doubles(out.select("signal_id", "horizon", "entry_date", "pnl", "equity", "rebased"))


def q_b16(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = realised(spark, sf_dir).withColumn("direction", F.when(F.col("signal") == 1, "long").otherwise("short"))
    t = t.withColumn("ret", F.when(F.col("signal") == 1, F.col("long_return")).otherwise(F.col("short_return")))
    return round_doubles(BT.strategy_summary(t, ["horizon", "direction"], "ret"))


def q_b18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward 21-row return of each ticker's daily close."""
    px = daily_prices(spark, sf_dir)
    out = ordered_select(px, ["ticker"], ["date"],
                         [lambda w: [(F.lead("close", BENCH_ROWS).over(w) / F.col("close") - 1).alias("fwd_return_21")]],
                         fwd=BENCH_ROWS)
    return round_doubles(out)


# --- DuckDB oracles ---------------------------------------------------------

SQL_PX = """SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
  arg_min(value + 1.0, (ts, event_id)) AS open, arg_max(value + 1.0, (ts, event_id)) AS close
FROM events GROUP BY 1, 2"""

SQL_SIG = " UNION ALL ".join(
    f"SELECT event_id AS signal_id, event_type AS ticker, CAST(ts AS DATE) AS transaction_date, "
    f"{h} AS horizon, (value - {PRED_SHIFT[h]}) / 100 AS pred FROM events" for h in HORIZONS)

SQL_REALISED = f"""
WITH px AS ({SQL_PX}), s AS ({SQL_SIG}),
e AS (SELECT s.*, CASE WHEN pred > 0 THEN 1 ELSE -1 END AS signal, p.date AS entry_date, p.open AS entry_open
      FROM s ASOF LEFT JOIN px p ON s.ticker = p.ticker AND s.transaction_date < p.date),
x AS (SELECT e.*, p.date AS x_date, p.close AS x_close
      FROM e ASOF LEFT JOIN px p ON e.ticker = p.ticker AND CAST(e.transaction_date + e.horizon AS DATE) <= p.date)
SELECT signal_id, ticker, transaction_date, horizon, pred, signal, entry_date,
  CASE WHEN entry_date IS NOT NULL THEN x_date END AS exit_date, CASE WHEN x_date IS NOT NULL THEN entry_open END AS entry_price,
  CASE WHEN entry_date IS NOT NULL THEN x_close END AS exit_price,
  (CASE WHEN entry_date IS NOT NULL THEN x_close END - entry_open) / entry_open AS long_return,
  (entry_open - CASE WHEN entry_date IS NOT NULL THEN x_close END) / entry_open AS short_return
FROM x"""

SQL_B10 = sql_round_select(SQL_REALISED, ["signal_id", "ticker", "transaction_date", "horizon", "signal",
                                          "entry_date", "exit_date"],
                           ["pred", "entry_price", "exit_price", "long_return", "short_return"],
                           dates=["transaction_date", "entry_date", "exit_date"])

SQL_B14_HORIZONS = sql_round_select(f"""
WITH r AS ({SQL_REALISED}),
f AS (SELECT signal_id, horizon, entry_date,
             CAST(floor(coalesce(1000.0 * (long_return - 0.002) * CAST(signal = 1 AS INTEGER), 0.0) * 1000000 + 0.5) AS BIGINT) AS micro
      FROM r WHERE entry_date IS NOT NULL),
g AS (SELECT signal_id, horizon, entry_date, micro / 1000000 AS pnl,
             10000.0 + sum(micro) OVER (PARTITION BY horizon ORDER BY entry_date, signal_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 1000000 AS equity FROM f),
h AS (SELECT horizon, arg_min(equity, (entry_date, signal_id)) AS first_eq FROM g GROUP BY 1)
SELECT g.*, equity / nullif(first_eq, 0) * 10000.0 AS rebased FROM g JOIN h USING (horizon)""",
    ["signal_id", "horizon", "entry_date"], ["pnl", "equity", "rebased"], dates=["entry_date"])

SQL_B16 = sql_round_select(f"""
WITH r AS ({SQL_REALISED}),
t AS (SELECT horizon, CASE WHEN signal = 1 THEN 'long' ELSE 'short' END AS direction,
             CASE WHEN signal = 1 THEN long_return ELSE short_return END AS ret FROM r)
SELECT horizon, direction, count(ret) AS trades, sum(ret) AS total_return, avg(ret) AS avg_return,
       count(ret) FILTER (WHERE ret > 0) / nullif(count(ret), 0) AS win_rate
FROM t GROUP BY 1, 2""", ["horizon", "direction", "trades"], ["total_return", "avg_return", "win_rate"])

SQL_B18 = sql_round_select(f"""
SELECT *, lead(close, {BENCH_ROWS}) OVER (PARTITION BY ticker ORDER BY date) / close - 1 AS fwd_return_21
FROM ({SQL_PX}) p""", ["ticker", "date"], ["open", "close", "fwd_return_21"], dates=["date"])

QUERIES = {"b10": q_b10, "b11": q_b11, "b13": q_b13, "b14_horizons": q_b14_horizons, "b16": q_b16, "b18": q_b18}
ORACLE = {"b10": SQL_B10, "b14_horizons": SQL_B14_HORIZONS, "b16": SQL_B16, "b18": SQL_B18}
