"""Horizon returns on daily prices, batch scoring from saved models, point
look-ups and permutation importance (E9, B10, B13, M4, M11, M13, P25, W26).

Mapping: a trade is an order, its ticker the order's priority; a ticker's
daily prices are the first and last unit price of its line items by ship date.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions import clean as C
from quantspark.operators import backtest as BT
from quantspark.operators import evaluation as EV
from quantspark.operators import models as M
from quantspark.operators.events import join_null_safe
from quantspark.operators.ordered import rolling
from quantspark.operators.permutation import permutation_importance
from quantspark.operators.scoring import Registry, fit_bundle, score_requests
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.insider import raw_trades
from quantspark.plans.models import _split_features
from quantspark.plans.selection import HAR_WINDOWS
from quantspark.plans.zip import SQL_PRICING, pricing
from quantspark.session import ensure_checkpoint_dir, materialize, write_once
from quantspark.sources.tables import table

HORIZONS = BT.HORIZONS_DAYS
PRED_SHIFT = 150_000.0
TRAIN_UNTIL = "2000-01-01"
NUMBERS = ("last_price", "qty", "shares_held", "owned", "value")
# Fixed labels of a looked-up region.
LABELS = {"UNDERPRICED": "Underpriced (High Risk)", "OVERPRICED": "Overpriced (Low Risk)"}
OTHER_LABEL = "Adequately Priced"


def ticker_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, date, open, close): calendar-bounded daily prices."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", F.to_date("l_shipdate").alias("date"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("ticker"))
    # a day's first and last order are longs, hashed over all items; only their items are put in order
    ends = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("ticker", "date").agg(F.min("l_orderkey").alias("_lo"), F.max("l_orderkey").alias("_hi"))
    ends = ends.select("ticker", F.col("date").alias("_day"), F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_order"))
    j = li.join(ends, (li.l_orderkey == ends._order) & li.date.eqNullSafe(ends._day))
    price, order = F.col("l_extendedprice") / F.col("l_quantity"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return j.groupBy("ticker", "date").agg(F.min_by(price, order).alias("open"), F.max_by(price, order).alias("close"))


def horizon_returns(spark: SparkSession, sf_dir: str, horizons=HORIZONS) -> DataFrame:
    """B10 + E9: the realised returns of every trade over each horizon."""
    o = table(spark, sf_dir, "orders")
    preds = {h: f"pred_{h}d" for h in horizons}
    s = o.select(F.col("o_orderkey").alias("trade_id"), F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("transaction_date"),
                 *[((F.col("o_totalprice") - PRED_SHIFT) / (1000 * h)).alias(c) for h, c in preds.items()])
    return BT.signal_returns(BT.unpivot_horizons(s, preds, ["trade_id", "ticker", "transaction_date"]), ticker_prices(spark, sf_dir))


def q_b10_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(horizon_returns(spark, sf_dir))


def horizon_summary(returns: DataFrame, key: str = "ticker", horizons=HORIZONS) -> DataFrame:
    """B13's wide form: per ticker, and over all of them (null ticker), one column per
    horizon and measure: trades with a return, mean signed return and win rate."""
    ret = F.when(F.col("signal") == 1, F.col("long_return")).otherwise(F.col("short_return"))
    r = returns.select(key, "horizon", ret.alias("ret"))
    out = []
    for h in horizons:
        x = F.when(F.col("horizon") == h, F.col("ret"))
        out += [F.count(x).alias(f"trades_{h}d"), F.avg(x).alias(f"avg_return_{h}d"),
                F.try_divide(F.count_if(x > 0), F.count(x)).alias(f"win_rate_{h}d")]
    return r.rollup(key).agg(F.grouping(key).cast("int").alias("is_total"), *out)


def q_b13_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(horizon_summary(horizon_returns(spark, sf_dir)))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade as a scoring request, its texts parsed."""
    return raw_trades(spark, sf_dir).select(
        "trade_id", F.upper("ticker").alias("ticker"), "transaction_type", "trade_date", "last_price", "qty",
        C.money("held_text").alias("shares_held"), C.percent_fraction("owned_text").alias("owned"), C.money("value_text").alias("value"))


def horizon_labels(spark: SparkSession, sf_dir: str, horizons=HORIZONS) -> DataFrame:
    """B10 + E9 as labels: (trade_id, and for each horizon h ``{h}_ret``, the long return, and
    ``{h}_exit``). They follow from ticker and day, so the look-up is done and pivoted on
    the days with trades, bounded by the calendar, and joined once to the trades."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trade_id"), F.col("o_orderpriority").alias("ticker"),
                                              F.to_date("o_orderdate").alias("transaction_date"))
    prices = write_once(ticker_prices(spark, sf_dir), "ticker-prices")
    days = o.select("ticker", "transaction_date").distinct().withColumn("pred", F.lit(0.0))
    r = BT.signal_returns(BT.unpivot_horizons(days, {h: "pred" for h in horizons}, ["ticker", "transaction_date"]), prices)
    wide = write_once(r.groupBy("ticker", "transaction_date").pivot("horizon", list(horizons)).agg(
        F.first("long_return").alias("ret"), F.first("exit_date").alias("exit")), "day-labels")
    columns = [f"{h}_{c}" for h in horizons for c in ("ret", "exit")]
    t = join_null_safe(o, wide, ["ticker", "transaction_date"], *columns)
    return t.groupBy("trade_id").agg(*[F.first(c).alias(c) for c in columns])


def train_bundles(spark: SparkSession, sf_dir: str, registry: Registry, horizons=HORIZONS, kind: str = "gbt") -> None:
    """One bundle per horizon, fitted on the trades whose horizon ends before the cut
    and measured on those after it."""
    t = materialize(requests(spark, sf_dir).join(horizon_labels(spark, sf_dir, horizons), "trade_id"))
    cut = F.lit(TRAIN_UNTIL).cast("date")

    def fit(h: int) -> None:
        train, held = t.filter(F.col(f"{h}_exit") < cut), t.filter(F.col("trade_date") >= cut)
        registry.save(f"return_{h}d", fit_bundle(train, held, f"{h}_ret", "ticker", "transaction_type", NUMBERS, kind))

    with ThreadPoolExecutor(max_workers=len(horizons)) as pool:
        list(pool.map(fit, horizons))


def q_m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + S11: bundles of the three horizons are fitted and saved; one job loads
    them and scores every trade since the cut, with a confidence per row."""
    registry = Registry(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}")
    train_bundles(spark, sf_dir, registry)
    asked = requests(spark, sf_dir).filter(F.col("trade_date") >= F.lit(TRAIN_UNTIL).cast("date"))
    return score_requests(write_once(asked, "asked"), registry, {f"{h}d": f"return_{h}d" for h in HORIZONS}, ["trade_id", "ticker"])


def har_table(spark: SparkSession, sf_dir: str, windows=(24, 168, 720)) -> DataFrame:
    """Means of realised volatility over several windows, per asset (bars of one
    asset are bounded by the calendar); rows in which a window does not fill go."""
    f = _split_features(spark, sf_dir)
    w = Window.partitionBy("asset").orderBy("bar_ts")
    f = f.select("*", *[rolling(F.avg, "realized_vol_24h", w, n).alias(f"har_{n}") for n in windows])
    return materialize(f.dropna(subset=[f"har_{n}" for n in windows]))


def q_m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 + M4: permutation importance of the HAR terms on the test rows, 20 repeats."""
    f = har_table(spark, sf_dir, HAR_WINDOWS)
    har = [f"har_{n}" for n in HAR_WINDOWS]
    model = M.pipeline(har, M.regressor("ridge", "target_vol_24h", n_rows=None), scale=False).fit(
        f.filter((F.col("split") == "train") & F.col("target_vol_24h").isNotNull()))
    return permutation_importance(model, f.filter(F.col("split") == "test"), har, "target_vol_24h", [F.col("asset"), F.col("bar_ts")])


def q_m4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + W26: HAR regression against the last value, errors per split."""
    f = har_table(spark, sf_dir, HAR_WINDOWS)
    har = [f"har_{n}" for n in HAR_WINDOWS]
    model = M.pipeline(har, M.regressor("ridge", "target_vol_24h", n_rows=None), scale=False).fit(
        f.filter((F.col("split") == "train") & F.col("target_vol_24h").isNotNull()))
    s = model.transform(f).select("split", "target_vol_24h", F.explode(F.array(
        F.struct(F.lit("har").alias("model"), F.col("prediction").alias("pred")),
        F.struct(F.lit("persistence").alias("model"), F.col("realized_vol_24h").alias("pred")))).alias("m"))
    return EV.regression_metrics(s.select("split", "target_vol_24h", "m.model", "m.pred"), ["model", "split"], "target_vol_24h", "pred")


def look_up(table_: DataFrame, asked: DataFrame, key: str, first: str) -> DataFrame:
    """P25: one row per asked key: its first row by ``first``, missing or infinite numbers
    as 0, and its label; keys that the table lacks have ``found`` false and nulls."""
    numbers = [f.name for f in table_.schema.fields if f.dataType.typeName() in ("double", "float")]
    rows = table_.groupBy(key).agg(F.min_by(F.struct(*[c for c in table_.columns if c != key]), first).alias("_r"))
    got = asked.select(key).distinct().join(rows, key, "left")
    zeroed = [F.when(F.col("_r").isNotNull(), F.when(F.isnan(f"_r.{c}") | F.col(f"_r.{c}").isin(float("inf"), float("-inf")), 0.0).otherwise(
        F.coalesce(f"_r.{c}", F.lit(0.0)))).alias(c) if c in numbers else F.col(f"_r.{c}").alias(c) for c in table_.columns if c != key]
    out = got.select(key, F.col("_r").isNotNull().alias("found"), *zeroed)
    label = None
    for category, text in LABELS.items():
        is_it = F.col("Pricing_Category") == category
        label = F.when(is_it, text) if label is None else label.when(is_it, text)
    return out.withColumn("classification", F.when(F.col("found"), label.otherwise(OTHER_LABEL)))


def q_p25(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zip_code"))
    return round_doubles(look_up(pricing(spark, sf_dir), asked, "zip_code", "year"), 6, {"Earned_Premium": 2})


# --- DuckDB oracles ---------------------------------------------------------

SQL_TICKER_PRICES = """SELECT o_orderpriority AS ticker, CAST(l_shipdate AS DATE) AS date,
  arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_extendedprice, l_quantity)) AS open,
  arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_extendedprice, l_quantity)) AS close
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""

SQL_RETURNS = f"""
WITH px AS ({SQL_TICKER_PRICES}),
s AS ({' UNION ALL '.join(f"SELECT o_orderkey AS trade_id, o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS transaction_date, {h} AS horizon, (o_totalprice - {PRED_SHIFT}) / (1000 * {h}) AS pred FROM orders" for h in HORIZONS)}),
e AS (SELECT s.*, CASE WHEN pred > 0 THEN 1 ELSE -1 END AS signal, p.date AS entry_date, p.open AS entry_open
      FROM s ASOF LEFT JOIN px p ON s.ticker = p.ticker AND s.transaction_date < p.date),
x AS (SELECT e.*, CASE WHEN entry_date IS NOT NULL THEN p.date END AS exit_date, p.close AS x_close
      FROM e ASOF LEFT JOIN px p ON e.ticker = p.ticker AND CAST(e.transaction_date + e.horizon AS DATE) <= p.date),
y AS (SELECT *, CASE WHEN exit_date IS NOT NULL THEN entry_open END AS entry_price, CASE WHEN exit_date IS NOT NULL THEN x_close END AS exit_price FROM x)
SELECT trade_id, ticker, transaction_date, horizon, pred, signal, entry_date, exit_date, entry_price, exit_price,
  (exit_price - entry_price) / entry_price AS long_return, (entry_price - exit_price) / entry_price AS short_return FROM y"""

SQL_B10_DAYS = sql_round_select(SQL_RETURNS, ["trade_id", "ticker", "transaction_date", "horizon", "signal", "entry_date", "exit_date"],
                                ["pred", "entry_price", "exit_price", "long_return", "short_return"],
                                dates=["transaction_date", "entry_date", "exit_date"])

_WIDE = ", ".join(f"count(ret) FILTER (WHERE horizon = {h}) AS trades_{h}d, avg(ret) FILTER (WHERE horizon = {h}) AS avg_return_{h}d, "
                  f"count(*) FILTER (WHERE horizon = {h} AND ret > 0) / nullif(count(ret) FILTER (WHERE horizon = {h}), 0) AS win_rate_{h}d"
                  for h in HORIZONS)
SQL_B13_SUMMARY = sql_round_select(f"""
SELECT ticker, CAST(grouping(ticker) AS INTEGER) AS is_total, {_WIDE}
FROM (SELECT *, CASE WHEN signal = 1 THEN long_return ELSE short_return END AS ret FROM ({SQL_RETURNS}) r) q GROUP BY ROLLUP (ticker)""",
    ["ticker", "is_total", *[f"trades_{h}d" for h in HORIZONS]], [f"{m}_{h}d" for h in HORIZONS for m in ("avg_return", "win_rate")])

_P25_NUM = ["Earned_Premium", "Earned_Exposure", "Composite_Risk_Score", "Actual_Premium_per_Exposure", "Predicted_Premium_per_Exposure",
            "Prediction_Error", "Prediction_Error_Pct", "Absolute_Error", "Recommended_Rate_Change_Pct"]
SQL_P25 = sql_round_select(f"""
WITH p AS ({SQL_PRICING}),
f AS (SELECT p.* FROM p JOIN (SELECT zip_code, min(year) AS year FROM p GROUP BY 1) m ON p.zip_code = m.zip_code AND p.year = m.year)
SELECT n.n_nationkey AS zip_code, f.zip_code IS NOT NULL AS found, f.year, f.Pricing_Category,
  {', '.join(f"CASE WHEN f.zip_code IS NOT NULL THEN CASE WHEN {c} IS NULL OR isinf({c}) OR isnan({c}) THEN 0.0 ELSE {c} END END AS {c}" for c in _P25_NUM)},
  CASE WHEN f.zip_code IS NULL THEN NULL {' '.join(f"WHEN Pricing_Category = '{k}' THEN '{v}'" for k, v in LABELS.items())} ELSE '{OTHER_LABEL}' END AS classification
FROM nation n LEFT JOIN f ON n.n_nationkey = f.zip_code""",
    ["zip_code", "found", "year", "Pricing_Category", "classification"], _P25_NUM, 6, {"Earned_Premium": 2})

QUERIES = {"b10_days": q_b10_days, "b13_summary": q_b13_summary, "m4": q_m4, "m11": q_m11, "m13": q_m13, "p25": q_p25}
ORACLE = {"b10_days": SQL_B10_DAYS, "b13_summary": SQL_B13_SUMMARY, "p25": SQL_P25}
