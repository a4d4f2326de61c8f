"""Monthly factor panel and cross-sectional evaluation on ``lineitem``
(A3, A4, J4, J12, W3-W5, W12, W25, W30, C1-C3, C12-C14, W23, B19, B20, R3).

Mapping: ticker = supplier, daily price = mean unit price of its lines that
day, month-end price = last non-null daily price of the month, market cap
= monthly extended-price sum. Quarterly fundamentals = revenue of orders
per customer nation and quarter, attached to each supplier-month through
the supplier's nation with row-presence as-of semantics.

Windows per ticker run over months (bounded by the calendar); every
cross-section is ranked by ranges of (month, value), so that no month has to
fit one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions.numeric import qcut_of_rank, safe_div
from quantspark.operators.asof import asof_join
from quantspark.operators.bars import last_valid_per_period
from quantspark.operators.ordered import ordered_select, rolling
from quantspark.operators.ranks import rank_rows, with_tie_ranks
from quantspark.operators.stats import winsorize_by, zscore_by
from quantspark.plans.common import round_doubles, sql_round_select, sql_roll
from quantspark.session import write_once
from quantspark.sources.tables import table

FACTORS = ["ret_1m", "mom_3m", "ma_dist_3m", "vol_3m", "log_mcap", "avg_disc", "avg_tax", "fund_growth"]
TECHNICAL = ["ret_1m", "mom_3m", "ma_dist_3m", "vol_3m"]
FUNDAMENTAL = ["log_mcap", "avg_disc", "avg_tax", "fund_growth"]
QUINTILES = 5


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    daily = li.groupBy(F.col("l_suppkey").alias("ticker"), day.alias("date")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    # A3: month-end last non-null value
    month_px = last_valid_per_period(daily, ["ticker"], F.last_day("date"), "date", ["price"], "month_end")
    # A4: monthly sums / means
    month_fx = li.groupBy(F.col("l_suppkey").alias("ticker"), F.last_day(day).alias("month_end")).agg(
        F.ln(F.sum("l_extendedprice")).alias("log_mcap"), F.avg("l_discount").alias("avg_disc"),
        F.avg("l_tax").alias("avg_tax"))
    # Star of factor tables on (month, ticker)
    p = month_px.join(month_fx, ["ticker", "month_end"], "left")

    # quarterly fundamentals per nation, W30 growth, J12 presence as-of
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    q = (o.join(c, o.o_custkey == c.c_custkey)
          .groupBy(F.col("c_nationkey").alias("nation"),
                   F.last_day(F.add_months(F.trunc(F.to_date("o_orderdate"), "quarter"), 2)).alias("q_end"))
          .agg(F.sum("o_totalprice").alias("revenue")))
    q = ordered_select(q, ["nation"], ["q_end"],
                       [lambda w: [(F.col("revenue") / F.lag("revenue", 1).over(w) - 1).alias("fund_growth")]], back=1)
    last_q = q.groupBy("nation").agg(F.max("q_end").alias("last_q"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_nationkey").alias("nation"))
    p = p.join(s, "ticker", "left")
    p = asof_join(p, q, ["nation"], "month_end", "q_end", ["fund_growth"], direction="backward", prefix="q_")
    p = (p.join(last_q, "nation", "left")
          .withColumn("fund_growth", F.when(F.col("month_end") <= F.col("last_q"), F.col("q_fund_growth")))
          .drop("q_fund_growth", "q_matched", "last_q"))

    # per-ticker monthly windows (W3, W4, W5, W12) then lags (W25) and target
    def level1(w):
        return [(F.col("price") / F.lag("price", 1).over(w) - 1).alias("ret_1m"),
                (F.col("price") / F.lag("price", 3).over(w) - 1).alias("mom_3m"),
                (F.col("price") / rolling(F.avg, "price", w, 3) - 1).alias("ma_dist_3m")]

    def level2(w):
        lags = [F.lag(f, 1).over(w).alias(f"{f}_l1") for f in TECHNICAL]
        lags += [F.lag(f, 2).over(w).alias(f"{f}_l2") for f in FUNDAMENTAL]
        return [rolling(F.stddev_samp, "ret_1m", w, 3).alias("vol_3m"),
                F.lead("ret_1m", 1).over(w).alias("next_ret"), *lags[:3], *lags[4:]]

    def level3(w):
        return [F.lag("vol_3m", 1).over(w).alias("vol_3m_l1")]

    p = ordered_select(p, ["ticker"], ["month_end"], [level1, level2, level3], back=6, fwd=2)
    return p


def q_d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = monthly_panel(spark, sf_dir)
    return round_doubles(p.select("ticker", "month_end", "nation", "price", "next_ret", *FACTORS,
                                  *[f"{f}_l1" for f in TECHNICAL], *[f"{f}_l2" for f in FUNDAMENTAL]))


LAGGED = [f"{f}_l1" for f in TECHNICAL] + [f"{f}_l2" for f in FUNDAMENTAL]


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2: winsorise each lagged factor per month at 1%/99%, then
    z-score per month (sample std); score = mean of available z-scores."""
    p = write_once(monthly_panel(spark, sf_dir).select("ticker", "month_end", "next_ret", *LAGGED), "panel")
    p = winsorize_by(p, ["month_end"], LAGGED)
    p = zscore_by(p, ["month_end"], LAGGED)
    zs = [F.col(c) for c in LAGGED]
    n = sum(F.when(z.isNotNull(), 1).otherwise(0) for z in zs)
    tot = sum(F.coalesce(z, F.lit(0.0)) for z in zs)
    return p.withColumn("score", safe_div(tot, n))


def q_c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(standardized(spark, sf_dir))


def quintiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank by falling score (first occurrence wins ties; quintile 0 holds
    the best) and pandas-qcut into
    five groups per month."""
    p = standardized(spark, sf_dir).filter(F.col("score").isNotNull())
    p = rank_rows(p, ["month_end"], [F.desc("score"), F.col("ticker")])
    return p.withColumn("quintile", qcut_of_rank("rank", "n", QUINTILES))


def q_w23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(quintiles(spark, sf_dir).select("ticker", "month_end", "score", "rank", "n", "quintile"))


def q_b19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19 + W19: mean next-month return per (month, quintile) and the
    compounded curve per quintile, reported in log space (sum of
    ln(1 + r)); ``compound_curve`` gives the plain product."""
    q = quintiles(spark, sf_dir).filter(F.col("next_ret").isNotNull())
    m = q.groupBy("quintile", "month_end").agg(F.avg("next_ret").alias("port_ret"), F.count(F.lit(1)).alias("names"))
    w = Window.partitionBy("quintile").orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("log_curve", F.sum(F.when(F.col("port_ret") > -1, F.ln(1 + F.col("port_ret")))).over(w))
    return round_doubles(m, 6)


def compound_curve(df: DataFrame, keys, order: str, ret: str, out: str = "curve") -> DataFrame:
    """Running product of (1 + r) per key (keys bounded by the
    calendar, e.g. one row per month)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.product(1 + F.col(ret)).over(w))


def q_b20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B20 + R3: months as rows, quintiles as columns, Q1-Q5 spread; then
    the mean of each column."""
    q = quintiles(spark, sf_dir).filter(F.col("next_ret").isNotNull())
    wide = q.groupBy("month_end").pivot("quintile", list(range(QUINTILES))).agg(F.avg("next_ret"))
    wide = wide.select("month_end", *[F.col(str(i)).alias(f"q{i + 1}") for i in range(QUINTILES)])
    wide = wide.withColumn("spread", F.col("q1") - F.col(f"q{QUINTILES}"))
    return round_doubles(wide.agg(*[F.avg(c).alias(f"mean_{c}") for c in
                                    [f"q{i + 1}" for i in range(QUINTILES)] + ["spread"]],
                                  F.count(F.lit(1)).alias("months")))


def ic_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 + C13: Pearson and Spearman (average-rank) correlation of score
    with next-month return per month."""
    p = standardized(spark, sf_dir).filter(F.col("score").isNotNull() & F.col("next_ret").isNotNull())
    p = with_tie_ranks(p, ["month_end"], {"r_score": "score", "r_ret": "next_ret"})
    return p.groupBy("month_end").agg(F.corr("score", "next_ret").alias("ic_pearson"),
                                      F.corr("r_score", "r_ret").alias("ic_spearman"),
                                      F.count(F.lit(1)).alias("names"))


def q_c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(ic_by_month(spark, sf_dir))


def q_c14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: IC mean, std and information ratio."""
    ic = ic_by_month(spark, sf_dir)
    out = ic.agg(*[x for c in ("ic_pearson", "ic_spearman") for x in (
        F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
        safe_div(F.avg(c), F.stddev_samp(c)).alias(f"{c}_ir"))])
    return round_doubles(out)


# --- DuckDB oracles ---------------------------------------------------------

def _panel_sql() -> str:
    lag_cols = ", ".join([f"lag({f}, 1) OVER w AS {f}_l1" for f in TECHNICAL[:3]] +
                         [f"lag({f}, 2) OVER w AS {f}_l2" for f in FUNDAMENTAL])
    return f"""
WITH daily AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date,
                      avg(l_extendedprice / l_quantity) AS price FROM lineitem GROUP BY 1, 2),
mp AS (SELECT ticker, last_day(date) AS month_end, arg_max(price, date) FILTER (WHERE price IS NOT NULL) AS price
       FROM daily GROUP BY 1, 2),
mf AS (SELECT l_suppkey AS ticker, last_day(CAST(l_shipdate AS DATE)) AS month_end, ln(sum(l_extendedprice)) AS log_mcap,
              avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax FROM lineitem GROUP BY 1, 2),
q0 AS (SELECT c_nationkey AS nation, last_day(date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL 2 MONTH) AS q_end,
              sum(o_totalprice) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
q AS (SELECT nation, CAST(q_end AS DATE) AS q_end, revenue / lag(revenue) OVER (PARTITION BY nation ORDER BY q_end) - 1 AS fund_growth FROM q0),
lq AS (SELECT nation, max(q_end) AS last_q FROM q GROUP BY 1),
p0 AS (SELECT mp.ticker, mp.month_end, s_nationkey AS nation, price, log_mcap, avg_disc, avg_tax
       FROM mp LEFT JOIN mf USING (ticker, month_end) LEFT JOIN supplier ON s_suppkey = mp.ticker),
p1 AS (SELECT p0.*, CASE WHEN p0.month_end <= lq.last_q THEN q.fund_growth END AS fund_growth
       FROM p0 ASOF LEFT JOIN q ON p0.nation = q.nation AND p0.month_end >= q.q_end
       LEFT JOIN lq ON lq.nation = p0.nation),
p2 AS (SELECT *, price / lag(price, 1) OVER w - 1 AS ret_1m, price / lag(price, 3) OVER w - 1 AS mom_3m,
              price / ({sql_roll('avg', 'price', 3, 'ticker', 'month_end')}) - 1 AS ma_dist_3m
       FROM p1 WINDOW w AS (PARTITION BY ticker ORDER BY month_end)),
p3 AS (SELECT *, {sql_roll('stddev_samp', 'ret_1m', 3, 'ticker', 'month_end')} AS vol_3m,
              lead(ret_1m, 1) OVER w AS next_ret, {lag_cols}
       FROM p2 WINDOW w AS (PARTITION BY ticker ORDER BY month_end))
SELECT *, lag(vol_3m, 1) OVER (PARTITION BY ticker ORDER BY month_end) AS vol_3m_l1 FROM p3"""


SQL_PANEL = _panel_sql()
SQL_D5 = sql_round_select(SQL_PANEL, ["ticker", "month_end", "nation"],
                          ["price", "next_ret", *FACTORS, *LAGGED], dates=["month_end"])


def _std_sql() -> str:
    bounds = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in LAGGED)
    wins = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} "
                     f"ELSE {c} END AS {c}" for c in LAGGED)
    zs = ", ".join(f"({c} - avg({c}) OVER m) / nullif(stddev_samp({c}) OVER m, 0) AS {c}" for c in LAGGED)
    n = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in LAGGED)
    tot = " + ".join(f"coalesce({c}, 0.0)" for c in LAGGED)
    return f"""
WITH p AS (SELECT ticker, month_end, next_ret, {', '.join(LAGGED)} FROM ({SQL_PANEL}) x),
b AS (SELECT month_end, {bounds} FROM p GROUP BY 1),
w AS (SELECT ticker, month_end, next_ret, {wins} FROM p JOIN b USING (month_end)),
z AS (SELECT ticker, month_end, next_ret, {zs} FROM w WINDOW m AS (PARTITION BY month_end))
SELECT *, ({tot}) / nullif({n}, 0) AS score FROM z"""


SQL_STD = _std_sql()
SQL_C1 = sql_round_select(SQL_STD, ["ticker", "month_end"], ["next_ret", *LAGGED, "score"], dates=["month_end"])

SQL_Q = f"""
WITH s AS (SELECT * FROM ({SQL_STD}) x WHERE score IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY month_end ORDER BY score DESC, ticker) AS rank,
             count(*) OVER (PARTITION BY month_end) AS n FROM s)
SELECT *, CAST(CASE WHEN n = 1 OR rank = 1 THEN 0
                    ELSE floor(((rank - 1) * {QUINTILES} + (n - 2)) / (n - 1)) - 1 END AS INTEGER) AS quintile FROM r"""

SQL_W23 = sql_round_select(f"SELECT ticker, month_end, score, rank, n, quintile FROM ({SQL_Q}) q",
                           ["ticker", "month_end", "rank", "n", "quintile"], ["score"], dates=["month_end"])

SQL_B19 = sql_round_select(f"""
WITH m AS (SELECT quintile, month_end, avg(next_ret) AS port_ret, count(*) AS names
           FROM ({SQL_Q}) q WHERE next_ret IS NOT NULL GROUP BY 1, 2)
SELECT *, sum(CASE WHEN port_ret > -1 THEN ln(1 + port_ret) END) OVER (PARTITION BY quintile ORDER BY month_end
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS log_curve FROM m""",
    ["quintile", "month_end", "names"], ["port_ret", "log_curve"], dates=["month_end"])

_QS = [f"q{i + 1}" for i in range(QUINTILES)]
SQL_B20 = sql_round_select(f"""
WITH m AS (SELECT month_end, {', '.join(f'avg(next_ret) FILTER (WHERE quintile = {i}) AS q{i + 1}' for i in range(QUINTILES))}
           FROM ({SQL_Q}) q WHERE next_ret IS NOT NULL GROUP BY 1)
SELECT {', '.join(f'avg({c}) AS mean_{c}' for c in _QS)}, avg(q1 - q{QUINTILES}) AS mean_spread, count(*) AS months FROM m""",
    ["months"], [f"mean_{c}" for c in _QS] + ["mean_spread"])

SQL_IC = f"""
WITH s AS (SELECT * FROM ({SQL_STD}) x WHERE score IS NOT NULL AND next_ret IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY month_end ORDER BY score) + (count(*) OVER (PARTITION BY month_end, score) - 1) / 2.0 AS r_score,
              rank() OVER (PARTITION BY month_end ORDER BY next_ret) + (count(*) OVER (PARTITION BY month_end, next_ret) - 1) / 2.0 AS r_ret
       FROM s)
SELECT month_end, corr(score, next_ret) AS ic_pearson, corr(r_score, r_ret) AS ic_spearman, count(*) AS names
FROM r GROUP BY 1"""

SQL_C12 = sql_round_select(SQL_IC, ["month_end", "names"], ["ic_pearson", "ic_spearman"], dates=["month_end"])
SQL_C14 = sql_round_select(f"""
SELECT avg(ic_pearson) AS ic_pearson_mean, stddev_samp(ic_pearson) AS ic_pearson_std,
       avg(ic_pearson) / nullif(stddev_samp(ic_pearson), 0) AS ic_pearson_ir,
       avg(ic_spearman) AS ic_spearman_mean, stddev_samp(ic_spearman) AS ic_spearman_std,
       avg(ic_spearman) / nullif(stddev_samp(ic_spearman), 0) AS ic_spearman_ir
FROM ({SQL_IC}) i""", [], ["ic_pearson_mean", "ic_pearson_std", "ic_pearson_ir",
                           "ic_spearman_mean", "ic_spearman_std", "ic_spearman_ir"])

QUERIES = {"d5": q_d5, "c1": q_c1, "w23": q_w23, "b19": q_b19, "b20": q_b20, "c12": q_c12, "c14": q_c14}
ORACLE = {"d5": SQL_D5, "c1": SQL_C1, "w23": SQL_W23, "b19": SQL_B19, "b20": SQL_B20, "c12": SQL_C12, "c14": SQL_C14}
