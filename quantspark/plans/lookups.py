"""Lookups, update joins, display orders and simple split labels (P9, P26,
J17, J21, J22, K5, V5, E2, E10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators import evaluation as EV
from quantspark.operators.ordered import day_number, number_rows
from quantspark.operators.stats import global_quantiles
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.evaluation import SQL_SCORED, scored
from quantspark.sources.tables import daily_prices, table

# Region name -> code (one region deliberately unmapped).
REGION_CODES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU"}
# Display order of order priorities.
PRIORITY_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
K_FOLDS = 5
SPLIT_QUANTILE = 0.8


def dictionary_map(df: DataFrame, col: str, mapping: dict[str, str], out: str) -> DataFrame:
    """Map through a small literal table and drop unmapped rows. The
    table size is the dictionary's, known on the driver, so it is
    broadcast."""
    spark = df.sparkSession
    m = spark.createDataFrame(list(mapping.items()), f"{col} string, {out} string")
    return df.join(F.broadcast(m), col, "inner")


def q_p9(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name"))
    return dictionary_map(n.join(r, "n_regionkey"), "r_name", REGION_CODES, "region_code") \
        .select("n_nationkey", "n_name", "r_name", "region_code")


def q_j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances updated by the latest finished-order total
    where one exists (``DataFrame.update``: non-null right values win)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("value"))
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    upd = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("_new"))
    return round_doubles(c.join(upd, "c_custkey", "left")
                         .select("c_custkey", F.coalesce("_new", "value").alias("value")))


def q_j21(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily purchase counts mapped onto the price calendar by exact
    date, missing days 0."""
    px = daily_prices(spark, sf_dir).select("ticker", "date")
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    cnt = ev.groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("purchases"))
    return round_doubles(px.join(cnt, "date", "left").select("ticker", "date", F.coalesce("purchases", F.lit(0)).alias("purchases")))


def _importance(li: DataFrame, fn, name: str) -> DataFrame:
    cols = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    row = li.agg(*[fn(c).alias(c) for c in cols])
    return row.unpivot([], cols, "feature", name)


def q_j22(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J22 + W24: rank two importance tables (coefficient of variation and
    scaled mean), inner-join on feature, consensus rank."""
    li = table(spark, sf_dir, "lineitem")
    a = _importance(li, lambda c: F.stddev_samp(c) / F.avg(c), "imp_a")
    b = _importance(li, lambda c: F.log10(F.avg(c) + 1), "imp_b")
    a = a.withColumn("rank_a", F.row_number().over(Window.orderBy(F.col("imp_a").desc(), "feature")))
    b = b.withColumn("rank_b", F.row_number().over(Window.orderBy(F.col("imp_b").desc(), "feature")))
    j = a.join(b, "feature", "inner")
    return round_doubles(j.withColumn("consensus", (F.col("rank_a") + F.col("rank_b")) / 2.0))


def q_k5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: order counts per priority with an explicit display order."""
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    order = spark.createDataFrame([(p, i) for i, p in enumerate(PRIORITY_ORDER)], "o_orderpriority string, display_order int")
    return o.join(F.broadcast(order), "o_orderpriority", "left").orderBy("display_order")


def q_v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: test-split metrics by volatility regime (y up to the evaluated
    rows' 25th percentile, up to their 75th, above)."""
    t = scored(spark, sf_dir).filter((F.col("split") == "test") & F.col("y").isNotNull() & F.col("pred").isNotNull())
    t = t.join(t.groupBy("asset").agg(F.percentile("y", 0.25).alias("q25"), F.percentile("y", 0.75).alias("q75")), "asset")
    t = t.withColumn("regime", F.when(F.col("y") <= F.col("q25"), "low").when(F.col("y") <= F.col("q75"), "normal")
                     .otherwise("high"))
    return round_doubles(EV.regression_metrics(t, ["asset", "regime"], "y", "pred"))


def q_e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 + E10: date-quantile train/test cut (80% of rows' dates) and
    contiguous 5-fold ids on the global order of orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", day_number("o_orderdate").alias("day"))
    (cut,) = global_quantiles(o, "day", [SPLIT_QUANTILE])
    o = number_rows(o, [], ["o_orderdate", "o_orderkey"], F.col("day")).withColumnRenamed("_qs_rn", "pos")
    n = o.count()
    o = o.select("*", F.when(F.col("day") <= F.lit(cut), "train").otherwise("test").alias("split"),
                 EV.k_fold("pos", F.lit(n), K_FOLDS).alias("fold"))
    return o.groupBy("split", "fold").agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first_pos"),
                                          F.max("pos").alias("last_pos"))


# --- DuckDB oracles ---------------------------------------------------------

_REG = ", ".join(f"('{k}', '{v}')" for k, v in REGION_CODES.items())
SQL_P9 = f"""SELECT n_nationkey, n_name, r_name, m.region_code FROM nation JOIN region ON n_regionkey = r_regionkey
JOIN (VALUES {_REG}) m(r_name, region_code) USING (r_name)"""
SQL_J17 = sql_round_select("""SELECT c_custkey, coalesce(u.v, c_acctbal) AS value FROM customer LEFT JOIN (
  SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) u
  ON u.o_custkey = c_custkey""", ["c_custkey"], ["value"])
SQL_J21 = sql_round_select("""SELECT p.ticker, p.date, coalesce(c.purchases, 0) AS purchases
FROM (SELECT DISTINCT event_type AS ticker, CAST(ts AS DATE) AS date FROM events) p
LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1) c
USING (date)""", ["ticker", "date", "purchases"], [], dates=["date"])
_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
SQL_J22 = sql_round_select(f"""
WITH a AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, stddev_samp({c}) / avg({c}) AS imp_a FROM lineitem" for c in _COLS)}),
b AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, log10(avg({c}) + 1) AS imp_b FROM lineitem" for c in _COLS)}),
ra AS (SELECT *, row_number() OVER (ORDER BY imp_a DESC, feature) AS rank_a FROM a),
rb AS (SELECT *, row_number() OVER (ORDER BY imp_b DESC, feature) AS rank_b FROM b)
SELECT feature, imp_a, rank_a, imp_b, rank_b, (rank_a + rank_b) / 2.0 AS consensus FROM ra JOIN rb USING (feature)""",
    ["feature", "rank_a", "rank_b"], ["imp_a", "imp_b", "consensus"])
_ORD = ", ".join(f"('{p}', {i})" for i, p in enumerate(PRIORITY_ORDER))
SQL_K5 = f"""SELECT o_orderpriority, count(*) AS n, d.display_order FROM orders
LEFT JOIN (VALUES {_ORD}) d(o_orderpriority, display_order) USING (o_orderpriority) GROUP BY 1, 3 ORDER BY 3"""
SQL_V5 = sql_round_select(f"""
WITH s AS ({SQL_SCORED}),
e AS (SELECT * FROM s WHERE split = 'test' AND y IS NOT NULL AND pred IS NOT NULL),
q AS (SELECT asset, quantile_cont(y, 0.25) AS q25, quantile_cont(y, 0.75) AS q75 FROM e GROUP BY 1),
t AS (SELECT e.*, CASE WHEN y <= q25 THEN 'low' WHEN y <= q75 THEN 'normal' ELSE 'high' END AS regime
      FROM e JOIN q USING (asset))
SELECT asset, regime, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
  1 - sum((y - pred) * (y - pred)) / nullif(var_pop(y) * count(*), 0) AS r2,
  avg(CASE WHEN y <> 0 THEN abs((y - pred) / y) END) * 100 AS mape, avg(pred - y) AS mean_error,
  quantile_cont(abs(y - pred), 0.5) AS median_ae, max(abs(y - pred)) AS max_error,
  sqrt(avg((y - pred) * (y - pred))) / nullif(avg(y), 0) AS rel_rmse, avg(abs(y - pred)) / nullif(avg(y), 0) AS rel_mae
FROM t GROUP BY 1, 2""", ["asset", "regime", "n"],
    ["rmse", "mae", "r2", "mape", "mean_error", "median_ae", "max_error", "rel_rmse", "rel_mae"])
SQL_E2 = f"""
WITH o AS (SELECT o_orderkey, o_orderdate, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day,
                  row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos, count(*) OVER () AS n FROM orders),
c AS (SELECT quantile_cont(day, {SPLIT_QUANTILE}) AS cut FROM o)
SELECT CASE WHEN day <= cut THEN 'train' ELSE 'test' END AS split, CAST(CASE WHEN pos - 1 < (n % {K_FOLDS}) * (n // {K_FOLDS} + 1) THEN (pos - 1) // (n // {K_FOLDS} + 1)
            ELSE n % {K_FOLDS} + (pos - 1 - (n % {K_FOLDS}) * (n // {K_FOLDS} + 1)) // (n // {K_FOLDS}) END AS INTEGER) AS fold,
       count(*) AS rows, min(pos) AS first_pos, max(pos) AS last_pos FROM o, c GROUP BY 1, 2"""

QUERIES = {"p9": q_p9, "j17": q_j17, "j21": q_j21, "j22": q_j22, "k5": q_k5, "v5": q_v5, "e2": q_e2}
ORACLE = {"p9": SQL_P9, "j17": SQL_J17, "j21": SQL_J21, "j22": SQL_J22, "k5": SQL_K5, "v5": SQL_V5, "e2": SQL_E2}
