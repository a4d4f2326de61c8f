"""Sampling and shaping operators (P27, P28, P29, F7, R6, B28). A limit or
a stride is the feature here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators.ordered import day_number, number_rows
from quantspark.operators.volatility import volatility_features
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.crypto import SQL_BARS, hourly_bars
from quantspark.sources.tables import table

STRIDE = 10
SAMPLE_N = 25
SEED = 42
SCENARIO_N = 5
POSITIONS, LEVERAGES, COLLATERALS = ("long", "short"), (2.0, 5.0, 10.0, 20.0, 50.0), (500.0, 1000.0, 2000.0, 5000.0)
CHUNK_LEN = 24
TAIL_FRACTION = 0.2
CHUNK_START = 5


def q_p27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 10th bar of each asset by position (stride sampling)."""
    b = hourly_bars(spark, sf_dir)
    b = number_rows(b, ["asset"], ["bar_ts"], day_number("bar_ts")).withColumnRenamed("_qs_rn", "pos")
    return round_doubles(b.filter((F.col("pos") - 1) % STRIDE == 0).select("asset", "bar_ts", "pos", "close"))


def q_p28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of 25 customers (hash order, independent of
    partitioning)."""
    c = table(spark, sf_dir, "customer")
    return c.orderBy(F.xxhash64("c_custkey", F.lit(SEED)), "c_custkey").limit(SAMPLE_N) \
            .select("c_custkey", "c_mktsegment", "c_acctbal")


def q_b28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of hourly feature rows (hash order), each with a
    hash-drawn scenario and the market conditions of its hour."""
    d = volatility_features(hourly_bars(spark, sf_dir))
    row = ["asset", F.col("bar_ts").cast("string")]

    def drawn(values: tuple, salt: int) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(F.xxhash64(*row, F.lit(salt)), F.lit(len(values))).cast("int"))

    s = d.orderBy(F.xxhash64(*row, F.lit(SEED)), "asset", "bar_ts").limit(SCENARIO_N)
    return round_doubles(s.select(
        "asset", "bar_ts", drawn(POSITIONS, SEED + 1).alias("position"), drawn(LEVERAGES, SEED + 2).alias("leverage"),
        drawn(COLLATERALS, SEED + 3).alias("collateral"), F.col("realized_vol_24h").alias("volatility_24h"),
        F.col("volume_ratio_24h").alias("volume_ratio"), F.col("target_vol_24h").alias("actual_future_vol")))


def q_p29(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P29 + R6 + F7: a 24-bar chunk starting CHUNK_START bars into the last
    20% of each asset's bars, shaped as an ordered array of structs and as
    JSON text."""
    b = hourly_bars(spark, sf_dir)
    w = Window.partitionBy("asset").orderBy("bar_ts")
    b = b.withColumn("pos", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("asset")))
    start = F.floor(F.col("n") * (1 - TAIL_FRACTION)) + CHUNK_START
    ch = b.filter((F.col("pos") > start) & (F.col("pos") <= start + CHUNK_LEN))
    g = ch.groupBy("asset").agg(F.sort_array(F.collect_list(F.struct("pos", "bar_ts", "close"))).alias("path"),
                                F.count(F.lit(1)).alias("bars"), F.sum("close").alias("close_sum"))
    return round_doubles(g.select("asset", "bars", "close_sum", F.to_json("path").alias("path_json")))


SQL_P27 = sql_round_select(f"""SELECT asset, bar_ts, pos, close FROM (
  SELECT *, row_number() OVER (PARTITION BY asset ORDER BY bar_ts) AS pos FROM ({SQL_BARS}) b) x
WHERE (pos - 1) % {STRIDE} = 0""", ["asset", "bar_ts", "pos"], ["close"])

QUERIES = {"p27": q_p27, "p28": q_p28, "b28": q_b28, "p29": q_p29}
ORACLE = {"p27": SQL_P27}
