"""Monthly forecast paths of portfolio values.

Mapping: a ticker is a supplier, its monthly value its last unit price of the
month; a portfolio is a nation, its value the sum over its suppliers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators.smoothing import FITTED, SIMPLE, forecast_paths
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import table

# train: the years before this one
PREDICT_YEAR = 2001


def monthly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(portfolio, month, value, is_train), one row per month with any price."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    last = li.groupBy("l_suppkey", F.trunc(F.to_date("l_shipdate"), "month").alias("month")).agg(
        F.max_by(F.col("l_extendedprice") / F.col("l_quantity"), order).alias("close"))
    return (last.join(s, last.l_suppkey == s.s_suppkey).groupBy(F.col("s_nationkey").alias("portfolio"), "month")
            .agg(F.sum("close").alias("value")).withColumn("is_train", F.year("month") < PREDICT_YEAR))


def q_b24_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted values and forecasts of simple smoothing at the fixed weights."""
    return round_doubles(forecast_paths(monthly_values(spark, sf_dir), "portfolio", "month", "value", "is_train", SIMPLE).drop("beta"), 4)


def q_b25_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B24 + B25: the models whose weights are fitted to the train months."""
    return round_doubles(forecast_paths(monthly_values(spark, sf_dir), "portfolio", "month", "value", "is_train", FITTED), 4)


# --- DuckDB oracles ---------------------------------------------------------

_WEIGHTS = ", ".join(f"('{m}', {a})" for m, (_, a) in SIMPLE.items())
SQL_B24_PATHS = sql_round_select(f"""
WITH c AS (SELECT l_suppkey, date_trunc('month', CAST(l_shipdate AS DATE)) AS month,
                  arg_max(l_extendedprice / l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity)) AS close
           FROM lineitem GROUP BY 1, 2),
v AS (SELECT s_nationkey AS portfolio, month, sum(close) AS value FROM c JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
p AS (SELECT *, year(month) < {PREDICT_YEAR} AS is_train, row_number() OVER (PARTITION BY portfolio ORDER BY month) AS t FROM v),
n AS (SELECT portfolio, count(*) FILTER (WHERE is_train) AS n, arg_min(value, month) FILTER (WHERE is_train) AS x1 FROM p GROUP BY 1),
w AS (SELECT * FROM (VALUES {_WEIGHTS}) q(model, alpha)),
-- what a period knows: the train values before it
k AS (SELECT p.portfolio, p.month, p.value, p.is_train, least(p.t - 1, n.n) AS m, n.n, n.x1, w.model, CAST(w.alpha AS DOUBLE) AS alpha
      FROM p JOIN n USING (portfolio), w),
f AS (SELECT k.portfolio, k.month, k.model, sum(k.alpha * pow(1 - k.alpha, k.m - q.t) * q.value) AS weighted
      FROM k JOIN p q ON q.portfolio = k.portfolio AND q.t <= k.m GROUP BY 1, 2, 3)
SELECT portfolio, model, month, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, value, alpha,
  CASE WHEN n > 0 THEN pow(1 - alpha, m) * x1 + coalesce(weighted, 0.0) END AS path
FROM k LEFT JOIN f USING (portfolio, month, model)""", ["portfolio", "model", "month", "split"], ["value", "path", "alpha"], 4, dates=["month"])

QUERIES = {"b24_paths": q_b24_paths, "b25_paths": q_b25_paths}
ORACLE = {"b24_paths": SQL_B24_PATHS}
