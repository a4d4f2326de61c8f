"""Three-factor regressions and dummy columns.

Mapping: an index per line flag is an asset, its daily price the mean unit price
of the lines shipped that day; the factors are the market index less the rate,
small less large orders, and high less low discounts; the daily rate is the
mean tax over ``RATE_SCALE``. Windows per index run over days, which the calendar
bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators.linear import categories, dummies, ols
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import table

FACTORS = ["mkt_rf", "smb", "hml"]
RATE_SCALE = 25_200.0
SMALL_QUANTITY, HIGH_DISCOUNT = 25, 0.05
TRAIN_UNTIL = "1999-01-01"


def excess_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asset, date, excess_ret, mkt_rf, smb, hml): daily log returns over the rate."""
    li = table(spark, sf_dir, "lineitem")
    series = F.explode(F.array(
        F.lit("mkt"), F.when(F.col("l_quantity") <= SMALL_QUANTITY, "small").otherwise("big"),
        F.when(F.col("l_discount") >= HIGH_DISCOUNT, "high").otherwise("low"), F.concat(F.lit("flag_"), "l_returnflag")))
    daily = (li.select(F.to_date("l_shipdate").alias("date"), series.alias("series"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
             .filter(F.col("series").isNotNull()).groupBy("series", "date").agg(F.avg("price").alias("price")))
    w = Window.partitionBy("series").orderBy("date")
    ret = daily.withColumn("ret", F.ln("price") - F.ln(F.lag("price", 1).over(w)))
    rate = li.groupBy(F.to_date("l_shipdate").alias("date")).agg((F.avg("l_tax") / RATE_SCALE).alias("rf"))
    legs = ("mkt", "small", "big", "high", "low")
    wide = (ret.filter(F.col("series").isin(*legs)).groupBy("date").agg(*[F.max(F.when(F.col("series") == s, F.col("ret"))).alias(s) for s in legs])
            .join(rate, "date"))
    factors = wide.select("date", "rf", (F.col("mkt") - F.col("rf")).alias("mkt_rf"), (F.col("small") - F.col("big")).alias("smb"),
                          (F.col("high") - F.col("low")).alias("hml"))
    assets = ret.filter(F.col("series").startswith("flag_")).select(F.substring("series", 6, 100).alias("asset"), "date", "ret")
    return assets.join(factors, "date").select("asset", "date", (F.col("ret") - F.col("rf")).alias("excess_ret"), *FACTORS)


def q_c16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per asset, least squares with intercept of the excess return on
    three factors: coefficients, standard errors, t and p."""
    return round_doubles(ols(excess_returns(spark, sf_dir), ["asset"], "excess_ret", FACTORS), 6, {"t_value": 4, "std_err": 8, "coef": 8})


def q_r5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dummy columns of the order priorities seen before ``TRAIN_UNTIL``,
    the first left out, for all orders."""
    o = table(spark, sf_dir, "orders")
    split = F.when(F.col("o_orderdate") < F.lit(TRAIN_UNTIL).cast("timestamp"), "train").otherwise("test")
    o = o.select("o_orderkey", "o_orderpriority", split.alias("split"))
    seen = categories(o.filter(F.col("split") == "train"), "o_orderpriority")
    return o.select("o_orderkey", "split", *dummies("o_orderpriority", seen))


def _sql_c16() -> str:
    """The normal equations of three centred factors by cofactors."""
    x = FACTORS
    s = {(i, j): f"s{min(i, j)}{max(i, j)}" for i in range(3) for j in range(3)}
    sums = ", ".join([f"covar_pop({x[i]}, {x[j]}) * count(*) AS s{i}{j}" for i in range(3) for j in range(i, 3)]
                     + [f"covar_pop({x[i]}, excess_ret) * count(*) AS v{i}, avg({x[i]}) AS m{i}" for i in range(3)])

    def cofactor(i, j):
        r, c = [k for k in range(3) if k != i], [k for k in range(3) if k != j]
        sign = "" if (i + j) % 2 == 0 else "-"
        return f"{sign}({s[r[0], c[0]]} * {s[r[1], c[1]]} - {s[r[0], c[1]]} * {s[r[1], c[0]]})"

    det = " + ".join(f"s0{j} * ({cofactor(0, j)})" for j in range(3))
    inverse = ", ".join(f"({cofactor(i, j)}) / det AS i{i}{j}" for i in range(3) for j in range(3))
    beta = ", ".join(" + ".join(f"i{i}{j} * v{j}" for j in range(3)) + f" AS b{i}" for i in range(3))
    quad = " + ".join(f"m{i} * i{i}{j} * m{j}" for i in range(3) for j in range(3))
    terms = [("const", "my - m0 * b0 - m1 * b1 - m2 * b2", f"sqrt(s2 * (1 / n + {quad}))")] + [(x[i], f"b{i}", f"sqrt(s2 * i{i}{i})") for i in range(3)]
    rows = " UNION ALL ".join(f"SELECT asset, '{t}' AS term, {c} AS coef, {e} AS std_err, n, df_resid, r2 FROM f" for t, c, e in terms)
    # Student's t of whole degrees of freedom is a finite sum in the angle atan(t / sqrt(df))
    even = "list_sum(list_transform(range(0, df_resid // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1.0)) / sqrt(pi()) * pow(cos(a), 2 * k)))"
    odd = "list_sum(list_transform(range(0, (df_resid - 1) // 2), lambda k: exp(lgamma(k + 1.0) - lgamma(k + 1.5)) * sqrt(pi()) / 2 * pow(cos(a), 2 * k + 1)))"
    series = f"CASE WHEN df_resid % 2 = 0 THEN sin(a) * {even} ELSE 2 / pi() * (a + sin(a) * coalesce({odd}, 0)) END"
    return sql_round_select(sql_round_select(f"""
WITH daily AS (SELECT series, date, avg(price) AS price FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS price, unnest(['mkt',
        CASE WHEN l_quantity <= {SMALL_QUANTITY} THEN 'small' ELSE 'big' END, CASE WHEN l_discount >= {HIGH_DISCOUNT} THEN 'high' ELSE 'low' END,
        'flag_' || l_returnflag]) AS series FROM lineitem) WHERE series IS NOT NULL GROUP BY 1, 2),
ret AS (SELECT series, date, ln(price) - ln(lag(price) OVER (PARTITION BY series ORDER BY date)) AS ret FROM daily),
rate AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_tax) / {RATE_SCALE} AS rf FROM lineitem GROUP BY 1),
wide AS (SELECT date, {', '.join(f"max(ret) FILTER (WHERE series = '{c}') AS {c}" for c in ('mkt', 'small', 'big', 'high', 'low'))} FROM ret GROUP BY 1),
d AS (SELECT substr(series, 6) AS asset, ret - rf AS excess_ret, mkt - rf AS mkt_rf, small - big AS smb, high - low AS hml
      FROM ret JOIN wide USING (date) JOIN rate USING (date) WHERE starts_with(series, 'flag_')),
g AS (SELECT asset, count(*) AS n, avg(excess_ret) AS my, var_pop(excess_ret) * count(*) AS syy, {sums} FROM d
      WHERE excess_ret IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in x)} GROUP BY 1),
h AS (SELECT *, {det} AS det FROM g), i AS (SELECT *, {inverse} FROM h), b AS (SELECT *, {beta} FROM i),
f AS (SELECT *, n - 4 AS df_resid, (syy - b0 * v0 - b1 * v1 - b2 * v2) / (n - 4) AS s2, (b0 * v0 + b1 * v1 + b2 * v2) / syy AS r2 FROM b),
t AS (SELECT *, coef / std_err AS t_value, atan(abs(coef / std_err) / sqrt(df_resid)) AS a FROM ({rows}))
SELECT asset, term, coef, std_err, t_value, greatest(1 - {series}, 0) AS p_value, n, df_resid, r2, 4 AS rank FROM t""",
        ["asset", "term", "n", "df_resid", "rank", "coef", "std_err", "t_value"], ["p_value", "r2"]),
        ["asset", "term", "n", "df_resid", "rank", "p_value", "r2"], ["coef", "std_err", "t_value"], 8, {"t_value": 4})


_R5 = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SQL_R5 = f"""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{TRAIN_UNTIL}' THEN 'train' ELSE 'test' END AS split,
  {', '.join(f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"o_orderpriority_{v}\"" for v in _R5)} FROM orders"""

QUERIES = {"c16": q_c16, "r5": q_r5}
ORACLE = {"c16": _sql_c16(), "r5": SQL_R5}
