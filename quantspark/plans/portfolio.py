"""Positions, portfolio value curves, statistics and smoothing forecasts
(A16, A19, P10, B21-B25, K4).

Mapping: every customer holds |account balance| dollars of one event-type
"ticker" (by nation); portfolios are market segments. Daily OHLC per ticker
comes from the ticks; the daily spine per ticker is generated from the
ticker's own first and last day (a generator, bounded by the calendar).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators.ordered import prefix_select
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import table, ticks

TICKERS = ("click", "error", "purchase", "signup", "view")
TRADING_DAYS = 252
# Fixed rating bands of the Sharpe ratio (thresholds and labels).
STAR_BANDS = ((3, "★★★★★"), (2, "★★★★☆"), (1, "★★★☆☆"), (0, "★★☆☆☆"))
STAR_FLOOR = "★☆☆☆☆"
SES_ALPHAS = (0.2, 0.5)
ALPHA_GRID = tuple(round(0.05 * i, 2) for i in range(1, 20))
DAMPING = 0.99


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions merged per (portfolio, ticker)."""
    c = table(spark, sf_dir, "customer")
    tick = F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col("c_nationkey") % len(TICKERS)) + 1)
    return (c.select(F.col("c_mktsegment").alias("portfolio"), tick.alias("ticker"), F.abs("c_acctbal").alias("amount"))
             .groupBy("portfolio", "ticker").agg(F.sum("amount").alias("amount")))


def daily_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    order = F.struct("ts", "tick_id")
    return t.groupBy(F.col("asset").alias("ticker"), F.to_date("ts").alias("date")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", order).alias("close"))


def filled_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: every calendar day of each ticker, prices forward- then
    back-filled."""
    px = daily_ohlc(spark, sf_dir)
    span = px.groupBy("ticker").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    spine = span.select("ticker", F.explode(F.sequence("d0", "d1")).alias("date"))
    d = spine.join(px, ["ticker", "date"], "left")
    specs = [(k, c, f"_{k}_{c}") for c in ("open", "high", "low", "close") for k in ("ffill", "bfill")]
    d = prefix_select(d, ["ticker"], ["date"], specs)
    return d.select("ticker", "date", *[F.coalesce(f"_ffill_{c}", f"_bfill_{c}").alias(c)
                                         for c in ("open", "high", "low", "close")])


def portfolio_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value = sum over holdings of shares * price, shares = amount /
    first close of the ticker."""
    px = filled_prices(spark, sf_dir)
    first = px.groupBy("ticker").agg(F.min_by("close", "date").alias("first_close"))
    pos = positions(spark, sf_dir).join(first, "ticker").withColumn("shares", F.col("amount") / F.col("first_close"))
    j = pos.join(px, "ticker")
    return j.groupBy("portfolio", "date").agg(*[F.sum(F.col("shares") * F.col(c)).alias(c)
                                                for c in ("open", "high", "low", "close")])


def stars(sharpe: Column) -> Column:
    expr = None
    for thr, label in STAR_BANDS:
        expr = F.when(sharpe > thr, label) if expr is None else expr.when(sharpe > thr, label)
    return expr.otherwise(STAR_FLOOR)


def q_b21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(portfolio_values(spark, sf_dir), 4)


def q_b22(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B22 + K4: start/end value, return, percent change, daily-return
    volatility, annualised Sharpe with its star band, best and worst day by
    value (first date on ties)."""
    v = portfolio_values(spark, sf_dir).select("portfolio", "date", F.col("close").alias("value"))
    w = Window.partitionBy("portfolio").orderBy("date")
    v = v.withColumn("ret", F.col("value") / F.lag("value", 1).over(w) - 1)
    dn = F.datediff("date", F.lit("1970-01-01").cast("date"))
    s = v.groupBy("portfolio").agg(
        F.min_by("value", "date").alias("start_value"), F.max_by("value", "date").alias("end_value"),
        F.stddev_samp("ret").alias("volatility"), F.avg("ret").alias("_mean"),
        F.max("value").alias("best_day_value"), F.max_by("date", F.struct("value", -dn)).alias("best_day_date"),
        F.min("value").alias("worst_day_value"), F.min_by("date", F.struct("value", dn)).alias("worst_day_date"))
    sharpe = F.col("_mean") / F.col("volatility") * math.sqrt(TRADING_DAYS)
    s = s.select("portfolio", "start_value", "end_value", (F.col("end_value") - F.col("start_value")).alias("total_return"),
                 ((F.col("end_value") - F.col("start_value")) / F.col("start_value")).alias("percent_change"),
                 "volatility", sharpe.alias("sharpe_ratio"), stars(sharpe).alias("sharpe_rating"),
                 "best_day_value", "best_day_date", "worst_day_value", "worst_day_date")
    return round_doubles(s, 6, {"start_value": 4, "end_value": 4, "total_return": 4, "best_day_value": 4,
                                "worst_day_value": 4})


def q_b23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B23 + A16: per-ticker start/end close, change, volatility, latest day."""
    px = filled_prices(spark, sf_dir)
    w = Window.partitionBy("ticker").orderBy("date")
    px = px.withColumn("ret", F.col("close") / F.lag("close", 1).over(w) - 1)
    return round_doubles(px.groupBy("ticker").agg(
        F.min_by("close", "date").alias("start_close"), F.max_by("close", "date").alias("end_close"),
        ((F.max_by("close", "date") - F.min_by("close", "date")) / F.min_by("close", "date")).alias("percent_change"),
        F.stddev_samp("ret").alias("volatility"), F.max("date").alias("latest_date")))


def q_b23_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per position its start value (the amount put in), its value at the last
    close, total return and percent change (null for an empty position)."""
    px = filled_prices(spark, sf_dir)
    ends = px.groupBy("ticker").agg(F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close"))
    p = positions(spark, sf_dir).join(ends, "ticker")
    end = F.col("last_close") * (F.col("amount") / F.col("first_close"))
    return round_doubles(p.select("portfolio", "ticker", F.col("amount").alias("start_value"), end.alias("end_value"),
                                  (end - F.col("amount")).alias("total_return"),
                                  F.try_divide(end - F.col("amount"), F.col("amount")).alias("percent_change")), 4)


def latest_in_window(rows: DataFrame, keys: list[str], date: str, order: list[str], start: str, end: str) -> DataFrame:
    """Per key its latest row inside [start, end], else its latest row at all, as one
    aggregate; ``in_window`` tells which. Ties go to the larger ``order``; rows without a date
    count as the earliest."""
    inside = F.coalesce(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))
    others = [c for c in rows.columns if c not in keys]
    row = F.struct(inside.alias("in_window"), *others)
    return rows.groupBy(*keys).agg(F.max_by(row, F.struct(inside, F.col(date), *order)).alias("_r")).select(*keys, "_r.*")


A16_WINDOW = ("2000-01-01", "2000-03-31")


def q_a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's latest order of the quarter, else the latest of all."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice")
    return round_doubles(latest_in_window(o, ["o_custkey"], "date", ["o_orderkey"], *A16_WINDOW), 2)


def smoothing_forecasts(values: DataFrame, key: str, order: str, value: str, horizon: int = 5) -> DataFrame:
    """B24 + B25: simple exponential smoothing at fixed alphas and at the
    SSE-best alpha of a grid, Holt's linear trend at fixed weights, and Holt's
    linear, exponential and damped (``DAMPING``) trends at the SSE-best weights
    of a grid, as folds (``aggregate``) over each series' ordered array. Series
    are bounded by the calendar (one value per period); a series of one value,
    or of zeros under the exponential trend, has no trend forecast."""
    arr = F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda s: s[value])
    g = values.groupBy(key).agg(arr.alias("xs"))

    def ses(alpha: float) -> Column:
        # state (level, sse); level starts at the first value
        init = F.struct(F.element_at("xs", 1).alias("l"), F.lit(0.0).alias("sse"))
        return F.aggregate(F.slice("xs", F.lit(2), F.size("xs")), init,
                           lambda st, x: F.struct((alpha * x + (1 - alpha) * st["l"]).alias("l"),
                                                  (st["sse"] + (x - st["l"]) * (x - st["l"])).alias("sse")))

    def holt(alpha: float, beta: float) -> Column:
        first, second = F.get("xs", F.lit(0)), F.get("xs", F.lit(1))
        init = F.struct(second.alias("l"), (second - first).alias("b"))

        def step(st, x):
            lvl = alpha * x + (1 - alpha) * (st["l"] + st["b"])
            return F.struct(lvl.alias("l"), (beta * (lvl - st["l"]) + (1 - beta) * st["b"]).alias("b"))
        return F.aggregate(F.slice("xs", F.lit(3), F.size("xs")), init, step)

    def holt_fitted(kind: str) -> Column:
        grow = kind == "exponential"
        damp = DAMPING if kind == "damped" else 1.0
        x1, x2 = F.get("xs", F.lit(0)), F.get("xs", F.lit(1))

        def ahead(st) -> Column:
            return st["l"] * st["b"] if grow else st["l"] + damp * st["b"]

        def step(p):
            def fold(st, x):
                lvl = p["alpha"] * x + (1 - p["alpha"]) * ahead(st)
                change = F.try_divide(lvl, st["l"]) if grow else lvl - st["l"]
                old = st["b"] if grow else damp * st["b"]
                return F.struct(lvl.alias("l"), (p["beta"] * change + (1 - p["beta"]) * old).alias("b"),
                                (st["sse"] + (x - ahead(st)) * (x - ahead(st))).alias("sse"))
            return fold

        def path(p) -> Column:
            init = F.struct(x2.alias("l"), (F.try_divide(x2, x1) if grow else x2 - x1).alias("b"), F.lit(0.0).alias("sse"))
            st = F.aggregate(F.slice("xs", F.lit(3), F.size("xs")), init, step(p))
            reach = sum(damp ** k for k in range(1, horizon + 1))
            end = st["l"] * F.pow(st["b"], F.lit(horizon)) if grow else st["l"] + reach * st["b"]
            return F.struct(st["sse"].alias("sse"), p["alpha"], p["beta"], end.alias("forecast"))

        weights = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a in ALPHA_GRID for b in ALPHA_GRID])
        fits = F.filter(F.transform(weights, path), lambda f: f["sse"].isNotNull() & f["forecast"].isNotNull())
        return F.array_min(fits)["forecast"]

    cols = [F.size("xs").alias("n")]
    for a in SES_ALPHAS:
        cols.append(ses(a)["l"].alias(f"ses_{int(a * 100)}_forecast"))
    grid = F.array(*[F.struct(ses(a)["sse"].alias("sse"), F.lit(a).alias("alpha"), ses(a)["l"].alias("l"))
                     for a in ALPHA_GRID])
    best = F.array_min(grid)
    cols += [best["alpha"].alias("ses_best_alpha"), best["l"].alias("ses_best_forecast")]
    h = holt(0.8, 0.2)
    cols += [(h["l"] + horizon * h["b"]).alias(f"holt_forecast_{horizon}")]
    cols += [holt_fitted(k).alias(f"holt_{k}_forecast_{horizon}") for k in ("linear", "exponential", "damped")]
    return g.select(key, *cols)


def q_b24(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = portfolio_values(spark, sf_dir)
    return round_doubles(smoothing_forecasts(v, "portfolio", "date", "close"), 4)


# --- DuckDB oracles ---------------------------------------------------------

_TICK_ARR = "[" + ", ".join(f"'{t}'" for t in TICKERS) + "]"
SQL_VALUES = f"""
WITH pos AS (SELECT c_mktsegment AS portfolio, list_extract({_TICK_ARR}, CAST(c_nationkey % {len(TICKERS)} + 1 AS INTEGER)) AS ticker,
                    sum(abs(c_acctbal)) AS amount FROM customer GROUP BY 1, 2),
px AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS date, arg_min(value + 1.0, (ts, event_id)) AS open,
              max(value + 1.0) AS high, min(value + 1.0) AS low, arg_max(value + 1.0, (ts, event_id)) AS close
       FROM events GROUP BY 1, 2),
sp AS (SELECT ticker, CAST(unnest(range(min(date), max(date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
       FROM px GROUP BY 1),
d AS (SELECT sp.ticker, sp.date, px.open, px.high, px.low, px.close FROM sp LEFT JOIN px USING (ticker, date)),
f AS (SELECT ticker, date,
        {', '.join(f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}" for c in ('open', 'high', 'low', 'close'))}
      FROM d),
fc AS (SELECT ticker, arg_min(close, date) AS first_close FROM f GROUP BY 1),
sh AS (SELECT pos.*, amount / first_close AS shares FROM pos JOIN fc USING (ticker))
SELECT portfolio, date, {', '.join(f'sum(shares * {c}) AS {c}' for c in ('open', 'high', 'low', 'close'))}
FROM sh JOIN f USING (ticker) GROUP BY 1, 2"""

SQL_B21 = sql_round_select(SQL_VALUES, ["portfolio", "date"], ["open", "high", "low", "close"], 4, dates=["date"])

_STARS = " ".join(f"WHEN sharpe > {t} THEN '{lab}'" for t, lab in STAR_BANDS)
SQL_B22 = sql_round_select(f"""
WITH v AS (SELECT portfolio, date, close AS value FROM ({SQL_VALUES}) x),
r AS (SELECT *, value / lag(value) OVER (PARTITION BY portfolio ORDER BY date) - 1 AS ret FROM v),
s AS (SELECT portfolio, arg_min(value, date) AS start_value, arg_max(value, date) AS end_value,
             stddev_samp(ret) AS volatility, avg(ret) AS m, max(value) AS best_day_value,
             arg_max(date, (value, -(date - DATE '1970-01-01'))) AS best_day_date, min(value) AS worst_day_value,
             arg_min(date, (value, date - DATE '1970-01-01')) AS worst_day_date FROM r GROUP BY 1),
t AS (SELECT *, m / volatility * {repr(math.sqrt(TRADING_DAYS))} AS sharpe FROM s)
SELECT portfolio, start_value, end_value, end_value - start_value AS total_return,
  (end_value - start_value) / start_value AS percent_change, volatility, sharpe AS sharpe_ratio,
  CASE {_STARS} ELSE '{STAR_FLOOR}' END AS sharpe_rating, best_day_value, best_day_date, worst_day_value, worst_day_date
FROM t""", ["portfolio", "sharpe_rating", "best_day_date", "worst_day_date"],
    ["start_value", "end_value", "total_return", "percent_change", "volatility", "sharpe_ratio", "best_day_value",
     "worst_day_value"], 6, {"start_value": 4, "end_value": 4, "total_return": 4, "best_day_value": 4,
                             "worst_day_value": 4}, dates=["best_day_date", "worst_day_date"])

SQL_FILLED = SQL_VALUES[:SQL_VALUES.index("fc AS (")].rstrip().rstrip(",") + "\nSELECT * FROM f"
SQL_B23 = sql_round_select(f"""
WITH r AS (SELECT *, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM ({SQL_FILLED}) x)
SELECT ticker, arg_min(close, date) AS start_close, arg_max(close, date) AS end_close,
  (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) AS percent_change,
  stddev_samp(ret) AS volatility, max(date) AS latest_date FROM r GROUP BY 1""",
    ["ticker", "latest_date"], ["start_close", "end_close", "percent_change", "volatility"], dates=["latest_date"])

SQL_B23_POSITIONS = sql_round_select(f"""
WITH pos AS (SELECT c_mktsegment AS portfolio, list_extract({_TICK_ARR}, CAST(c_nationkey % {len(TICKERS)} + 1 AS INTEGER)) AS ticker,
                    sum(abs(c_acctbal)) AS amount FROM customer GROUP BY 1, 2),
e AS (SELECT ticker, arg_min(close, date) AS first_close, arg_max(close, date) AS last_close FROM ({SQL_FILLED}) x GROUP BY 1),
v AS (SELECT portfolio, ticker, amount AS start_value, last_close * (amount / first_close) AS end_value FROM pos JOIN e USING (ticker))
SELECT *, end_value - start_value AS total_return, (end_value - start_value) / nullif(start_value, 0) AS percent_change FROM v""",
    ["portfolio", "ticker"], ["start_value", "end_value", "total_return", "percent_change"], 4)

SQL_A16 = sql_round_select(f"""
SELECT DISTINCT ON (o_custkey) o_custkey, CAST(o_orderdate AS DATE) BETWEEN DATE '{A16_WINDOW[0]}' AND DATE '{A16_WINDOW[1]}' AS in_window,
  CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice
FROM orders ORDER BY o_custkey, in_window DESC, date DESC, o_orderkey DESC""",
    ["o_custkey", "in_window", "date", "o_orderkey"], ["o_totalprice"], 2, dates=["date"])

QUERIES = {"a16": q_a16, "b23_positions": q_b23_positions, "b21": q_b21, "b22": q_b22, "b23": q_b23, "b24": q_b24}
ORACLE = {"a16": SQL_A16, "b23_positions": SQL_B23_POSITIONS, "b21": SQL_B21, "b22": SQL_B22, "b23": SQL_B23}
