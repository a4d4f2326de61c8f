"""Ranked lists, pivots, string cleaning, range filters and a partitioned
gzip CSV scan (B27, R4, P8, P16, P21, B12, S2, S7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions import clean as C
from quantspark.operators.backtest import rebase
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.portfolio import SQL_VALUES, portfolio_values
from quantspark.plans.signals import SQL_REALISED, realised
from quantspark.session import ensure_checkpoint_dir
from quantspark.sources import files as FS
from quantspark.sources.tables import daily_prices, table

K = 5
RANGE_START, RANGE_END = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
OUTLIER_ABS = 0.5


def q_b27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k and bottom-k suppliers by average discount with rank and
    universe size (the limits are the report)."""
    li = table(spark, sf_dir, "lineitem")
    s = li.groupBy("l_suppkey").agg(F.avg("l_discount").alias("score"))
    n = s.count()
    top = s.orderBy(F.col("score").desc(), "l_suppkey").limit(K).withColumn("side", F.lit("top"))
    bot = s.orderBy(F.col("score").asc(), "l_suppkey").limit(K).withColumn("side", F.lit("bottom"))
    out = top.unionByName(bot)
    w = Window.partitionBy("side").orderBy(F.when(F.col("side") == "top", -F.col("score")).otherwise(F.col("score")),
                                           "l_suppkey")
    return round_doubles(out.withColumn("rank", F.row_number().over(w)).withColumn("n_universe", F.lit(n)))


def q_r4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot table of mean extended price, return flag x line status."""
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(li.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).avg("l_extendedprice"), 4)


def q_p8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 + P1: upper-cased trimmed names with a word removed anywhere, and
    zero-padded nation codes; columns renamed and reordered."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), C.norm_ticker(C.strip_word("c_name", "Customer")).alias("name"),
                    C.zero_pad("c_nationkey", 3).alias("nation_code"))


def q_p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 + P21 + B12: realised long returns with |r| <= 0.5 inside a date
    range, fixed-stake curve per horizon rebased to 10,000 at the range
    start."""
    r = realised(spark, sf_dir).filter(F.col("long_return").isNotNull() & (F.abs("long_return") <= OUTLIER_ABS))
    r = r.filter(F.col("entry_date").between(RANGE_START, RANGE_END))
    d = r.groupBy("horizon", "entry_date").agg(F.avg("long_return").alias("day_ret"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("horizon").orderBy("entry_date").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("curve", F.lit(10000.0) + F.sum(F.col("day_ret") * 1000).over(w))
    return round_doubles(rebase(d, ["horizon"], "entry_date", "curve"))


def q_s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S2: daily prices written as gzip CSV partitioned by day, read
    back over a date range (folder pruning) with a ticker filter and a
    projected, date-parsed schema."""
    ensure_checkpoint_dir(spark)
    px = daily_prices(spark, sf_dir).withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    path = FS.scratch_path(spark, "daily-csv-gz")
    px.drop("date").write.mode("overwrite").option("header", True).option("compression", "gzip") \
      .partitionBy("day").csv(path)
    back = (spark.read.option("header", True).schema("ticker string, open double, close double, day date")
            .csv(path).filter(F.col("day").between(RANGE_START, RANGE_END) & (F.col("ticker") == "purchase")))
    return round_doubles(back.select("ticker", F.col("day").alias("date"), "close"))


# --- DuckDB oracles ---------------------------------------------------------

SQL_B27 = sql_round_select(f"""
WITH s AS (SELECT l_suppkey, avg(l_discount) AS score FROM lineitem GROUP BY 1),
t AS (SELECT *, 'top' AS side FROM s ORDER BY score DESC, l_suppkey LIMIT {K}),
b AS (SELECT *, 'bottom' AS side FROM s ORDER BY score ASC, l_suppkey LIMIT {K}),
u AS (SELECT * FROM t UNION ALL SELECT * FROM b)
SELECT *, row_number() OVER (PARTITION BY side ORDER BY CASE WHEN side = 'top' THEN -score ELSE score END, l_suppkey) AS rank,
       (SELECT count(*) FROM s) AS n_universe FROM u""", ["l_suppkey", "side", "rank", "n_universe"], ["score"])
SQL_R4 = sql_round_select("""SELECT l_returnflag, avg(l_extendedprice) FILTER (WHERE l_linestatus = 'F') AS F,
  avg(l_extendedprice) FILTER (WHERE l_linestatus = 'O') AS O FROM lineitem GROUP BY 1""", ["l_returnflag"], ["F", "O"], 4)
SQL_P8 = """SELECT c_custkey AS id, upper(trim(trim(replace(c_name, 'Customer', '')))) AS name,
  lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code FROM customer"""
SQL_P16 = sql_round_select(f"""
WITH r AS ({SQL_REALISED}),
d AS (SELECT horizon, entry_date, avg(long_return) AS day_ret, count(*) AS n FROM r
      WHERE long_return IS NOT NULL AND abs(long_return) <= {OUTLIER_ABS}
        AND entry_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' GROUP BY 1, 2),
c AS (SELECT *, 10000.0 + sum(day_ret * 1000) OVER (PARTITION BY horizon ORDER BY entry_date
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS curve FROM d),
f AS (SELECT horizon, arg_min(curve, entry_date) AS first FROM c GROUP BY 1)
SELECT c.*, curve / nullif(first, 0) * 10000.0 AS rebased FROM c JOIN f USING (horizon)""",
    ["horizon", "entry_date", "n"], ["day_ret", "curve", "rebased"], dates=["entry_date"])
SQL_S7 = sql_round_select(f"""SELECT event_type AS ticker, CAST(ts AS DATE) AS date, arg_max(value + 1.0, (ts, event_id)) AS close
FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'
GROUP BY 1, 2""", ["ticker", "date"], ["close"], dates=["date"])

QUERIES = {"b27": q_b27, "r4": q_r4, "p8": q_p8, "p16": q_p16, "s7": q_s7}
ORACLE = {"b27": SQL_B27, "r4": SQL_R4, "p8": SQL_P8, "p16": SQL_P16, "s7": SQL_S7}


def q_geo3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO3 + P12: fire-event table from returned line items: lenient
    dates, duration in days, standard acreage names, rows missing any
    required field dropped (end date exists only for finished lines,
    treated acres only for taxed lines)."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("zip_code"))
    ev = li.join(s, "l_suppkey").select(
        "zip_code", "l_orderkey", "l_linenumber",
        C.lenient_date("l_shipdate").alias("start_date"),
        F.when(F.col("l_linestatus") == "F", F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")))
         .alias("end_date"),
        (F.col("l_extendedprice") / 1000).alias("gis_acres"),
        F.when(F.col("l_tax") > 0, F.col("l_discount") * 100).alias("treated_ac"))
    ev = ev.withColumn("duration_days", F.datediff("end_date", "start_date"))
    ev = ev.withColumnsRenamed({"gis_acres": "acres", "treated_ac": "treated_acres"})
    return round_doubles(ev.dropna(subset=["zip_code", "start_date", "end_date", "duration_days", "treated_acres"]))


SQL_GEO3 = sql_round_select("""
SELECT s_nationkey AS zip_code, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS start_date,
  CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS DATE) END AS end_date,
  l_extendedprice / 1000 AS acres, CASE WHEN l_tax > 0 THEN l_discount * 100 END AS treated_acres,
  CAST(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) END AS INTEGER) AS duration_days
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_tax > 0""",
    ["zip_code", "l_orderkey", "l_linenumber", "start_date", "end_date", "duration_days"], ["acres", "treated_acres"],
    dates=["start_date", "end_date"])

QUERIES["geo3"] = q_geo3
ORACLE["geo3"] = SQL_GEO3
