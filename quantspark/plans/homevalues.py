"""Yearly home-value index by ZIP from a wide monthly table.

Mapping: a city is a supplier, its county the supplier's nation, its index of a
month the mean unit price of its lines, as text in a column per month; a ZIP is
the customer number modulo ``ZIPS``, and lies in every county where it has a
customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators.crosswalk import crosswalk_medians, melt_periods
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.session import materialize
from quantspark.sources.tables import table

ZIPS = 40


def wide_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(RegionID, county, yyyy-MM-dd ..): a row per city, a text column per month."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("RegionID"), F.col("s_nationkey").alias("county"))
    monthly = li.groupBy(F.col("l_suppkey").alias("RegionID"), F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd").alias("month")).agg(
        F.format_string("%.4f", F.avg(F.col("l_extendedprice") / F.col("l_quantity"))).alias("v"))
    months = [r[0] for r in monthly.select("month").distinct().orderBy("month").collect()]  # the calendar's months
    return monthly.groupBy("RegionID").pivot("month", months).agg(F.first("v")).join(s, "RegionID")


def q_zhvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 + J8: unpivot the months, carry them from counties to ZIPs, median per ZIP and year."""
    c = table(spark, sf_dir, "customer")
    zips = c.select(F.col("c_nationkey").alias("county"), (F.col("c_custkey") % ZIPS).alias("zip_code")).distinct()
    long = melt_periods(materialize(wide_index(spark, sf_dir)), ["county"], "ZHVI_value").withColumn("year", F.year("date")).drop("date")
    return round_doubles(crosswalk_medians(long, "county", ["year"], "ZHVI_value", zips, "zip_code"))


SQL_ZHVI = sql_round_select(f"""
WITH m AS (SELECT l_suppkey, last_day(CAST(l_shipdate AS DATE)) AS month, CAST(printf('%.4f', avg(l_extendedprice / l_quantity)) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2),
cities AS (SELECT DISTINCT l_suppkey, s_nationkey AS county FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
months AS (SELECT DISTINCT month FROM m),
z AS (SELECT DISTINCT c_nationkey AS county, c_custkey % {ZIPS} AS zip_code FROM customer)
SELECT zip_code, year(month) AS year, quantile_cont(v, 0.5) AS ZHVI_value
FROM cities JOIN z USING (county) CROSS JOIN months LEFT JOIN m USING (l_suppkey, month) GROUP BY 1, 2""", ["zip_code", "year"], ["ZHVI_value"])

QUERIES = {"zhvi": q_zhvi}
ORACLE = {"zhvi": SQL_ZHVI}
