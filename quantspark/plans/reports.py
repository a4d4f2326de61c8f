"""Descriptive reports and small ranked lists on the star tables
(A6, A9, A11-A15, A17, W24, W27, C3, C17, K1, K3, U2, V5, V7, V9).
All aggregates combine map-side before the shuffle."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions.numeric import binomial_moe
from quantspark.operators.ranks import wide_quantiles
from quantspark.operators.stats import describe, null_counts
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import table

HIST_WIDTH = 5000.0
TOP_K = 10


def q_a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts of order status with their share."""
    o = table(spark, sf_dir, "orders")
    c = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    total = o.count()
    return round_doubles(c.withColumn("share", F.col("n") / F.lit(float(total))))


def q_a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 + U2: distinct market segments and order priorities, as one sorted list."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("v"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("v"))
    return c.union(o).distinct().orderBy("v")


def q_a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Describe of three numeric columns."""
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(describe(li, ["l_quantity", "l_discount", "l_tax"]), 6, {"mean": 6})


def q_a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null counts per column of customer."""
    return null_counts(table(spark, sf_dir, "customer"))


def q_a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 + K4: the best line (highest extended price, lowest key on ties)
    per supplier, as a max_by aggregate (no per-group sort)."""
    li = table(spark, sf_dir, "lineitem")
    best = li.groupBy("l_suppkey").agg(F.max_by(F.struct("l_orderkey", "l_linenumber", "l_extendedprice"),
                                                F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_linenumber")))
                                       .alias("b"))
    return round_doubles(best.select("l_suppkey", "b.l_orderkey", "b.l_linenumber", "b.l_extendedprice"))


def q_a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width histogram of order totals and a log-binned one of
    account balances."""
    o = table(spark, sf_dir, "orders")
    lin = o.groupBy(F.floor(F.col("o_totalprice") / HIST_WIDTH).cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("linear"))
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    log = c.groupBy(F.floor(F.log10("c_acctbal") * 4).cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("log10x4"))
    return lin.unionByName(log)


def q_a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A9 + C17: per ship mode proxy (return flag): median, mean, std,
    count, share of discounted lines and its 95% margin."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag").agg(
        F.avg("l_extendedprice").alias("mean_price"),
        F.stddev_samp("l_extendedprice").alias("std_price"), F.count(F.lit(1)).alias("n"),
        F.avg((F.col("l_discount") > 0.05).cast("double")).alias("share_high_discount"))
    med = wide_quantiles(li, ["l_returnflag"], ["l_extendedprice"], [0.5]).withColumnRenamed("l_extendedprice_q0", "median_price")
    g = g.join(med, "l_returnflag", "left")
    return round_doubles(g.withColumn("moe_95", binomial_moe("share_high_discount", "n")), 6,
                         {"mean_price": 4, "std_price": 4, "median_price": 4})


def q_w24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W24 + K3 + K1: top-10 suppliers by revenue with global rank and
    universe size (limit is the report)."""
    li = table(spark, sf_dir, "lineitem")
    rev = li.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("revenue"))
    n = rev.count()
    top = rev.orderBy(F.col("revenue").desc(), F.col("l_suppkey")).limit(TOP_K)
    w = Window.orderBy(F.col("revenue").desc(), F.col("l_suppkey"))
    return round_doubles(top.withColumn("rank", F.row_number().over(w)).withColumn("n_universe", F.lit(n)), 2)


def q_w27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W27 + C3: per customer, slope (last - first) / first and growth
    (last - previous) / previous of order totals, then a population z-score
    of the slope across customers."""
    o = table(spark, sf_dir, "orders")
    order = F.struct("o_orderdate", "o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    last2 = o.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
    prev = last2.groupBy("o_custkey").agg(F.max_by("o_totalprice", F.col("_r")).alias("prev_total"),
                                          F.count(F.lit(1)).alias("_n"))
    fl = o.groupBy("o_custkey").agg(F.min_by("o_totalprice", order).alias("first_total"),
                                    F.max_by("o_totalprice", order).alias("last_total"))
    d = fl.join(prev, "o_custkey").select(
        "o_custkey", ((F.col("last_total") - F.col("first_total")) / F.col("first_total")).alias("slope"),
        F.when(F.col("_n") == 2, (F.col("last_total") - F.col("prev_total")) / F.col("prev_total")).alias("growth"))
    st = d.agg(F.avg("slope"), F.stddev_pop("slope")).first()
    return round_doubles(d.withColumn("slope_z", (F.col("slope") - st[0]) / st[1]))


# --- DuckDB oracles ---------------------------------------------------------

SQL_A11 = sql_round_select("""SELECT o_orderstatus, count(*) AS n, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM orders) AS share
FROM orders GROUP BY 1""", ["o_orderstatus", "n"], ["share"])
SQL_A12 = "SELECT DISTINCT v FROM (SELECT c_mktsegment AS v FROM customer UNION SELECT o_orderpriority FROM orders) x ORDER BY v"
SQL_A13 = sql_round_select(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")),
    ['"column"', "count"], ["mean", "std", "min", "p25", "p50", "p75", "max"])
SQL_A14 = "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
                                ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")) + " FROM customer"
SQL_A15 = sql_round_select("""SELECT l_suppkey, b.l_orderkey, b.l_linenumber, b.l_extendedprice FROM (
  SELECT l_suppkey, arg_max({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber, 'l_extendedprice': l_extendedprice},
                            (l_extendedprice, -l_orderkey, -l_linenumber)) AS b FROM lineitem GROUP BY 1) x""",
    ["l_suppkey", "l_orderkey", "l_linenumber"], ["l_extendedprice"])
SQL_A17 = f"""SELECT CAST(floor(o_totalprice / {HIST_WIDTH}) AS BIGINT) AS bin, count(*) AS n, 'linear' AS kind FROM orders GROUP BY 1
UNION ALL SELECT CAST(floor(log10(c_acctbal) * 4) AS BIGINT) AS bin, count(*) AS n, 'log10x4' AS kind FROM customer
WHERE c_acctbal > 0 GROUP BY 1"""
SQL_A6 = sql_round_select("""SELECT l_returnflag, median(l_extendedprice) AS median_price, avg(l_extendedprice) AS mean_price,
  stddev_samp(l_extendedprice) AS std_price, count(*) AS n, avg(CAST(l_discount > 0.05 AS DOUBLE)) AS share_high_discount,
  1.96 * sqrt(avg(CAST(l_discount > 0.05 AS DOUBLE)) * (1 - avg(CAST(l_discount > 0.05 AS DOUBLE))) / count(*)) AS moe_95
FROM lineitem GROUP BY 1""", ["l_returnflag", "n"], ["median_price", "mean_price", "std_price", "share_high_discount", "moe_95"],
    6, {"mean_price": 4, "std_price": 4, "median_price": 4})
SQL_W24 = sql_round_select(f"""SELECT l_suppkey, revenue, row_number() OVER (ORDER BY revenue DESC, l_suppkey) AS rank,
  (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_universe
FROM (SELECT l_suppkey, sum(l_extendedprice) AS revenue FROM lineitem GROUP BY 1) r
ORDER BY revenue DESC, l_suppkey LIMIT {TOP_K}""", ["l_suppkey", "rank", "n_universe"], ["revenue"], 2)
SQL_W27 = sql_round_select("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rr FROM orders),
p AS (SELECT o_custkey, arg_max(o_totalprice, rr) AS prev_total, count(*) AS n FROM r WHERE rr <= 2 GROUP BY 1),
f AS (SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_total,
             arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_total FROM orders GROUP BY 1),
d AS (SELECT o_custkey, (last_total - first_total) / first_total AS slope,
             CASE WHEN n = 2 THEN (last_total - prev_total) / prev_total END AS growth FROM f JOIN p USING (o_custkey))
SELECT *, (slope - (SELECT avg(slope) FROM d)) / (SELECT stddev_pop(slope) FROM d) AS slope_z FROM d""",
    ["o_custkey"], ["slope", "growth", "slope_z"])

QUERIES = {"a11": q_a11, "a12": q_a12, "a13": q_a13, "a14": q_a14, "a15": q_a15, "a17": q_a17, "a6": q_a6,
           "w24": q_w24, "w27": q_w27}
ORACLE = {"a11": SQL_A11, "a12": SQL_A12, "a13": SQL_A13, "a14": SQL_A14, "a15": SQL_A15, "a17": SQL_A17, "a6": SQL_A6,
          "w24": SQL_W24, "w27": SQL_W27}
