"""Hourly multi-series features and large-move labels (A2, P19, P20, J1-J3,
D3, D4, D10, W20, W22, R7).

Each event type is a series of hourly last prices. The pair is
(purchase, click); the all-asset table joins all five types. Hourly series
over a fixed span are bounded by the calendar, so the windows over the
merged series run without a partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators.bars import last_per_bar
from quantspark.operators.ordered import day_number, ordered_select, rolling
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import ticks

COIN, BTC = "purchase", "click"
OTHERS = ("error", "signup", "view")
HORIZON = 6
THRESHOLD_WINDOW = 50
SEQ_LEN = 6
LAGS = (1, 2, 3)
CHUNK_ROWS = 100_000
# Asset-set ablation lists
ASSET_SETS = {"coin_btc": (COIN, BTC), "plus_error": (COIN, BTC, "error"), "all": (COIN, BTC) + OTHERS}


def hourly_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: last price per (asset, hour); empty hours absent."""
    return last_per_bar(ticks(spark, sf_dir), ["asset"], "ts", "price", tiebreak="tick_id").withColumnRenamed("price", "close")


def _series(h: DataFrame, asset: str, name: str) -> DataFrame:
    return h.filter(F.col("asset") == asset).select("bar_ts", F.col("close").alias(name))


def overlap_crop(a: DataFrame, b: DataFrame, ts: str = "bar_ts") -> tuple[DataFrame, DataFrame]:
    """P20: keep both series inside [max of starts, min of ends] (two
    one-row aggregates, read as scalars)."""
    ra = a.agg(F.min(ts), F.max(ts)).first()
    rb = b.agg(F.min(ts), F.max(ts)).first()
    lo, hi = max(ra[0], rb[0]), min(ra[1], rb[1])
    return a.filter(F.col(ts).between(lo, hi)), b.filter(F.col(ts).between(lo, hi))


def pair_features(spark: SparkSession, sf_dir: str, drop_undefined: bool = True) -> DataFrame:
    """J1 + D3 + W22: inner join of two series on the hour, log returns,
    lags, 6-hour vols, spread, and the large-move label (future |H-hour
    return| above its trailing 50-row median)."""
    h = hourly_close(spark, sf_dir)
    coin, btc = overlap_crop(_series(h, COIN, "close"), _series(h, BTC, "btc_close"))
    m = coin.join(btc, "bar_ts", "inner")
    # one long series: windows in chunks of its rows, none over the whole table
    m = ordered_select(m, [], ["bar_ts"], [
        lambda w: [(F.ln("close") - F.ln(F.lag("close", 1).over(w))).alias("coin_ret_1h"),
                   (F.ln("btc_close") - F.ln(F.lag("btc_close", 1).over(w))).alias("btc_ret_1h"),
                   (F.ln(F.lead("close", HORIZON).over(w)) - F.ln("close")).alias("future_ret_H")],
        lambda w: [*[F.lag("coin_ret_1h", k).over(w).alias(f"coin_ret_lag_{k}") for k in (1, 2, 3)],
                   *[F.lag("btc_ret_1h", k).over(w).alias(f"btc_ret_lag_{k}") for k in (1, 2)],
                   rolling(F.stddev_samp, "coin_ret_1h", w, 6).alias("coin_vol_6h"),
                   rolling(F.stddev_samp, "btc_ret_1h", w, 6).alias("btc_vol_6h"),
                   (F.col("coin_ret_1h") - F.col("btc_ret_1h")).alias("coin_minus_btc"),
                   F.abs("future_ret_H").alias("future_abs_ret_H")],
        # Rolling median over ROWS frames via percentile (median() rejects frames)
        lambda w: [rolling(lambda c: F.percentile(c, 0.5), "future_abs_ret_H", w, THRESHOLD_WINDOW).alias("move_threshold_H")],
    ], back=THRESHOLD_WINDOW + 6 + 1, fwd=HORIZON, chunk_rows=CHUNK_ROWS, bucket=day_number("bar_ts"))
    m = m.withColumn("y_large_move", F.when(F.col("move_threshold_H").isNotNull(),
                                            (F.col("future_abs_ret_H") > F.col("move_threshold_H")).cast("int")))
    feats = ["coin_ret_1h", "coin_ret_lag_1", "coin_ret_lag_2", "coin_ret_lag_3", "btc_ret_1h", "btc_ret_lag_1",
             "btc_ret_lag_2", "coin_vol_6h", "btc_vol_6h", "coin_minus_btc"]
    if drop_undefined:
        m = m.dropna(subset=feats + ["y_large_move"])
    return m


def q_d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pair_features(spark, sf_dir))


def all_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + J3 + D4: coin and btc inner-joined, the other series left-joined
    on the hour; per-series return and its lags 1 to 3; whether the hour's own
    coin return is up (a first hour without a return is not)."""
    h = hourly_close(spark, sf_dir)
    m = _series(h, COIN, "coin").join(_series(h, BTC, "btc"), "bar_ts", "inner")
    for o in OTHERS:
        m = m.join(_series(h, o, o), "bar_ts", "left")
    names = ["coin", "btc", *OTHERS]

    def returns(w):
        return [(F.col(n) / F.lag(n, 1).over(w) - 1).alias(f"{n}_ret") for n in names]

    def lags(w):
        return [F.lag(f"{n}_ret", k).over(w).alias(f"{n}_ret_lag_{k}") for n in names for k in LAGS]

    # one series; rows are numbered by day and windows run in chunks
    m = ordered_select(m.withColumn("_series", F.lit(1)), ["_series"], ["bar_ts"], [returns, lags], back=1 + max(LAGS),
                       chunk_rows=CHUNK_ROWS, bucket=day_number("bar_ts")).drop("_series")
    return m.withColumn("target_up", F.coalesce(F.col("coin_ret") > 0, F.lit(False)).cast("int"))


def pair_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + D4, one row per (asset, hour) that the asset shares with btc: both
    closes and returns, their lags 1 to 3, and whether the asset's own return is
    up; rows without all lags are left out. All pairs run at once."""
    h = hourly_close(spark, sf_dir)
    btc = _series(h, BTC, "btc_close")
    m = h.filter(F.col("asset") != BTC).select("asset", "bar_ts", "close").join(btc, "bar_ts", "inner")

    def returns(w):
        return [(F.col(c) / F.lag(c, 1).over(w) - 1).alias(r) for c, r in (("btc_close", "btc_ret_1h"), ("close", "ret_1h"))]

    def lags(w):
        return [F.lag(f"{s}_1h", k).over(w).alias(f"{s}_lag_{k}") for s in ("btc_ret", "ret") for k in LAGS]

    m = ordered_select(m, ["asset"], ["bar_ts"], [returns, lags], back=1 + max(LAGS), chunk_rows=CHUNK_ROWS, bucket=day_number("bar_ts"))
    return m.withColumn("target_up", (F.col("ret_1h") > 0).cast("int")).dropna()


def q_d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(all_assets(spark, sf_dir))


def q_d4_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pair_returns(spark, sf_dir))


def market_hours(df: DataFrame, ts: str = "bar_ts", tz: str = "US/Eastern") -> DataFrame:
    """Keep Mon-Fri 09:30-16:00 local time, both ends inclusive."""
    # NTZ -> NTZ conversion: independent of the session time zone
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts))
    minutes = F.hour(local) * 60 + F.minute(local)
    return df.filter((F.weekday(local) < 5) & (minutes >= 9 * 60 + 30) & (minutes <= 16 * 60)) \
             .withColumn("local_ts", local)


def q_p19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(market_hours(hourly_close(spark, sf_dir)))


def q_r7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last six closes of each asset as an ordered array per row
    (null until six rows exist), with summary columns."""
    h = hourly_close(spark, sf_dir)
    w = Window.partitionBy("asset").orderBy("bar_ts").rowsBetween(-(SEQ_LEN - 1), 0)
    seq = F.collect_list("close").over(w)
    h = h.withColumn("seq", F.when(F.size(seq) == SEQ_LEN, seq))
    return round_doubles(h.select("asset", "bar_ts", F.size("seq").alias("seq_len"),
                                  F.element_at("seq", 1).alias("seq_first"), F.element_at("seq", -1).alias("seq_last"),
                                  F.aggregate("seq", F.lit(0.0), lambda a, x: a + x).alias("seq_sum")))


# --- DuckDB oracles ---------------------------------------------------------

SQL_CLOSE = """SELECT event_type AS asset, date_trunc('hour', ts) AS bar_ts, arg_max(value + 1.0, (ts, event_id)) AS close
FROM events GROUP BY 1, 2"""


def _series_sql(asset: str, name: str) -> str:
    return f"SELECT bar_ts, close AS {name} FROM h WHERE asset = '{asset}'"


_FEATS = ["coin_ret_1h", "coin_ret_lag_1", "coin_ret_lag_2", "coin_ret_lag_3", "btc_ret_1h", "btc_ret_lag_1",
          "btc_ret_lag_2", "coin_vol_6h", "btc_vol_6h", "coin_minus_btc"]

SQL_D3 = sql_round_select(f"""
WITH h AS ({SQL_CLOSE}), a AS ({_series_sql(COIN, 'close')}), b AS ({_series_sql(BTC, 'btc_close')}),
r AS (SELECT greatest((SELECT min(bar_ts) FROM a), (SELECT min(bar_ts) FROM b)) AS lo,
             least((SELECT max(bar_ts) FROM a), (SELECT max(bar_ts) FROM b)) AS hi),
m AS (SELECT a.bar_ts, a.close, b.btc_close FROM a JOIN b USING (bar_ts), r WHERE a.bar_ts BETWEEN r.lo AND r.hi),
m1 AS (SELECT *, ln(close) - ln(lag(close) OVER w) AS coin_ret_1h, ln(btc_close) - ln(lag(btc_close) OVER w) AS btc_ret_1h,
              ln(lead(close, {HORIZON}) OVER w) - ln(close) AS future_ret_H FROM m WINDOW w AS (ORDER BY bar_ts)),
m2 AS (SELECT *, lag(coin_ret_1h, 1) OVER w AS coin_ret_lag_1, lag(coin_ret_1h, 2) OVER w AS coin_ret_lag_2,
              lag(coin_ret_1h, 3) OVER w AS coin_ret_lag_3, lag(btc_ret_1h, 1) OVER w AS btc_ret_lag_1,
              lag(btc_ret_1h, 2) OVER w AS btc_ret_lag_2,
              CASE WHEN count(coin_ret_1h) OVER w6 = 6 THEN stddev_samp(coin_ret_1h) OVER w6 END AS coin_vol_6h,
              CASE WHEN count(btc_ret_1h) OVER w6 = 6 THEN stddev_samp(btc_ret_1h) OVER w6 END AS btc_vol_6h,
              coin_ret_1h - btc_ret_1h AS coin_minus_btc, abs(future_ret_H) AS future_abs_ret_H
       FROM m1 WINDOW w AS (ORDER BY bar_ts), w6 AS (ORDER BY bar_ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
m3 AS (SELECT *, CASE WHEN count(future_abs_ret_H) OVER w50 = {THRESHOLD_WINDOW}
                      THEN quantile_cont(future_abs_ret_H, 0.5) OVER w50 END AS move_threshold_H
       FROM m2 WINDOW w50 AS (ORDER BY bar_ts ROWS BETWEEN {THRESHOLD_WINDOW - 1} PRECEDING AND CURRENT ROW)),
m4 AS (SELECT *, CASE WHEN move_threshold_H IS NOT NULL THEN CAST(future_abs_ret_H > move_threshold_H AS INTEGER) END
                 AS y_large_move FROM m3)
SELECT * FROM m4 WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FEATS + ['y_large_move'])}""",
    ["bar_ts", "y_large_move"], ["close", "btc_close", "future_ret_H", *_FEATS, "future_abs_ret_H", "move_threshold_H"])

_NAMES = ["coin", "btc", *OTHERS]
SQL_D4 = sql_round_select(f"""
WITH h AS ({SQL_CLOSE}),
m AS (SELECT a.bar_ts, a.coin, b.btc, {', '.join(f'{o}.{o}' for o in OTHERS)}
      FROM ({_series_sql(COIN, 'coin')}) a JOIN ({_series_sql(BTC, 'btc')}) b USING (bar_ts)
      {' '.join(f"LEFT JOIN ({_series_sql(o, o)}) {o} ON {o}.bar_ts = a.bar_ts" for o in OTHERS)}),
m1 AS (SELECT *, {', '.join(f'{n} / lag({n}, 1) OVER w - 1 AS {n}_ret' for n in _NAMES)} FROM m WINDOW w AS (ORDER BY bar_ts))
SELECT *, {', '.join(f'lag({n}_ret, {k}) OVER w AS {n}_ret_lag_{k}' for n in _NAMES for k in LAGS)},
       CASE WHEN coin_ret > 0 THEN 1 ELSE 0 END AS target_up
FROM m1 WINDOW w AS (ORDER BY bar_ts)""", ["bar_ts", "target_up"],
    [*_NAMES, *[f"{n}_ret" for n in _NAMES], *[f"{n}_ret_lag_{k}" for n in _NAMES for k in LAGS]])

_PAIR_LAGS = [f"{s}_lag_{k}" for s in ("btc_ret", "ret") for k in LAGS]
SQL_D4_PAIRS = sql_round_select(f"""
WITH h AS ({SQL_CLOSE}), b AS ({_series_sql(BTC, 'btc_close')}),
m AS (SELECT h.asset, bar_ts, close, btc_close FROM h JOIN b USING (bar_ts) WHERE h.asset <> '{BTC}'),
m1 AS (SELECT *, btc_close / lag(btc_close) OVER w - 1 AS btc_ret_1h, close / lag(close) OVER w - 1 AS ret_1h
       FROM m WINDOW w AS (PARTITION BY asset ORDER BY bar_ts)),
m2 AS (SELECT *, {', '.join(f'lag({s}_1h, {k}) OVER w AS {s}_lag_{k}' for s in ('btc_ret', 'ret') for k in LAGS)}
       FROM m1 WINDOW w AS (PARTITION BY asset ORDER BY bar_ts))
SELECT *, CAST(ret_1h > 0 AS INTEGER) AS target_up FROM m2 WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _PAIR_LAGS)}""",
    ["asset", "bar_ts", "target_up"], ["close", "btc_close", "btc_ret_1h", "ret_1h", *_PAIR_LAGS])

SQL_P19 = sql_round_select(f"""
SELECT asset, bar_ts, close, CAST(timezone('US/Eastern', bar_ts AT TIME ZONE 'UTC') AS TIMESTAMP) AS local_ts
FROM ({SQL_CLOSE}) h
WHERE isodow(timezone('US/Eastern', bar_ts AT TIME ZONE 'UTC')) <= 5
  AND hour(timezone('US/Eastern', bar_ts AT TIME ZONE 'UTC')) * 60 + minute(timezone('US/Eastern', bar_ts AT TIME ZONE 'UTC'))
      BETWEEN 570 AND 960""", ["asset", "bar_ts", "local_ts"], ["close"])

SQL_R7 = sql_round_select(f"""
SELECT asset, bar_ts, CASE WHEN count(*) OVER w = {SEQ_LEN} THEN {SEQ_LEN} END AS seq_len,
  CASE WHEN count(*) OVER w = {SEQ_LEN} THEN first_value(close) OVER w END AS seq_first,
  CASE WHEN count(*) OVER w = {SEQ_LEN} THEN close END AS seq_last,
  CASE WHEN count(*) OVER w = {SEQ_LEN} THEN list_reduce(list(close) OVER w, lambda a, x: a + x, 0.0) END AS seq_sum
FROM ({SQL_CLOSE}) h WINDOW w AS (PARTITION BY asset ORDER BY bar_ts ROWS BETWEEN {SEQ_LEN - 1} PRECEDING AND CURRENT ROW)""",
    ["asset", "bar_ts", "seq_len"], ["seq_first", "seq_last", "seq_sum"])

QUERIES = {"d3": q_d3, "d4": q_d4, "d4_pairs": q_d4_pairs, "p19": q_p19, "r7": q_r7}
ORACLE = {"d3": SQL_D3, "d4": SQL_D4, "d4_pairs": SQL_D4_PAIRS, "p19": SQL_P19, "r7": SQL_R7}
