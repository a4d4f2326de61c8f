"""Access to the star-schema tables the jobs run on.

Every reader returns a lazy DataFrame; Catalyst prunes columns and pushes
filters into the Parquet scan, so callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick series view of ``events``: one series per event type.

    price = value + 1 keeps every price positive, volume is one unit per
    tick; ``event_id`` breaks ties between equal timestamps.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("asset"),
        F.col("ts"),
        F.col("event_id").alias("tick_id"),
        (F.col("value") + F.lit(1.0)).alias("price"),
        F.lit(1.0).alias("volume"),
    )


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, date, open, close) from ticks: open = first tick, close =
    last tick of the day. Partial aggregation runs before the shuffle."""
    t = ticks(spark, sf_dir)
    return (t.groupBy(F.col("asset").alias("ticker"), F.to_date("ts").alias("date"))
             .agg(F.min_by("price", F.struct("ts", "tick_id")).alias("open"),
                  F.max_by("price", F.struct("ts", "tick_id")).alias("close")))
