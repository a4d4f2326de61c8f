"""Latest cross-section of all factors and the compounded curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators.latest import growth, latest_valid, slope, with_previous_valid
from quantspark.operators.ranks import running_product
from quantspark.operators.stats import winsorize_by, zscore_by
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.panel import FACTORS, SQL_PANEL, SQL_Q, monthly_panel, quintiles
from quantspark.session import materialize

DIRECT = [f for f in FACTORS if f != "fund_growth"]
STAKE = 0.01  # share of equity in the quintile; unit prices of the tables move by hundreds of percent a month
ALL = [*DIRECT, "ma_slope", "mcap_growth", "inv_mcap"]


def q_d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 + J6: per ticker the last valid value of each factor with its age, left
    joined with the moving average's slope and the last growth of capital, then
    clipped at 1 % and 99 % and scored over the one cross-section (population
    deviation)."""
    p = monthly_panel(spark, sf_dir).select("ticker", "month_end", "price", *DIRECT)
    p = materialize(p.withColumn("ma_3m", F.col("price") / (1 + F.col("ma_dist_3m"))).withColumn("mcap", F.exp("log_mcap")))
    main = latest_valid(p, "ticker", "month_end", DIRECT).withColumn("inv_mcap", F.try_divide(F.lit(1.0), F.nullif("log_mcap", F.lit(0.0))))
    slopes = p.groupBy("ticker").agg(slope("ma_3m", "month_end").alias("ma_slope"))
    grown = with_previous_valid(p, "ticker", "month_end", ["mcap"]).groupBy("ticker").agg(growth("mcap", "month_end").alias("mcap_growth"))
    wide = main.join(slopes, "ticker", "left").join(grown, "ticker", "left").withColumn("_all", F.lit(1))
    z = zscore_by(winsorize_by(materialize(wide), ["_all"], ALL), ["_all"], ALL, sample=False)
    return round_doubles(z.drop("_all"))


def q_w19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W19 + B19: growth of 1 per quintile, the running product of 1 +
    ``STAKE`` times the month's mean return."""
    q = quintiles(spark, sf_dir).filter(F.col("next_ret").isNotNull())
    m = q.groupBy("quintile", "month_end").agg((1 + STAKE * F.avg("next_ret")).alias("growth"))
    return round_doubles(running_product(m, ["quintile"], [F.col("month_end")], "growth", "curve"))


def _d6_sql() -> str:
    last = ", ".join(f"arg_max({c}, month_end) FILTER (WHERE {c} IS NOT NULL) AS {c}, "
                     f"datediff('day', max(month_end) FILTER (WHERE {c} IS NOT NULL), (SELECT max(month_end) FROM p)) AS {c}_age" for c in DIRECT)
    bounds = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in ALL)
    clipped = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in ALL)
    z = ", ".join(f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS {c}" for c in ALL)
    ages = ", ".join(f"{c}_age" for c in DIRECT)
    return sql_round_select(f"""
WITH p AS (SELECT ticker, month_end, price / (1 + ma_dist_3m) AS ma_3m, exp(log_mcap) AS mcap, {', '.join(DIRECT)} FROM ({SQL_PANEL}) x),
v AS (SELECT *, last_value(mcap IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY month_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM p),
m AS (SELECT ticker, {last}, CASE WHEN count(ma_3m) >= 2 THEN arg_max(ma_3m, month_end) FILTER (WHERE ma_3m IS NOT NULL)
        / arg_min(ma_3m, month_end) FILTER (WHERE ma_3m IS NOT NULL) - 1 END AS ma_slope,
      arg_max(mcap, month_end) FILTER (WHERE mcap IS NOT NULL) / nullif(arg_max(prev, month_end) FILTER (WHERE mcap IS NOT NULL), 0) - 1 AS mcap_growth
      FROM v GROUP BY 1),
w AS (SELECT *, 1 / nullif(log_mcap, 0) AS inv_mcap FROM m), b AS (SELECT {bounds} FROM w),
c AS (SELECT ticker, {ages}, {clipped} FROM w, b)
SELECT ticker, {ages}, {z} FROM c""", ["ticker", *[f"{c}_age" for c in DIRECT]], ALL)


SQL_W19 = sql_round_select(f"""
WITH m AS (SELECT quintile, month_end, 1 + {STAKE} * avg(next_ret) AS growth FROM ({SQL_Q}) q WHERE next_ret IS NOT NULL GROUP BY 1, 2)
SELECT *, product(growth) OVER (PARTITION BY quintile ORDER BY month_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS curve FROM m""",
                           ["quintile", "month_end"], ["growth", "curve"], dates=["month_end"])

QUERIES = {"d6": q_d6, "w19": q_w19}
ORACLE = {"d6": _d6_sql(), "w19": SQL_W19}
