"""Incremental bar building with Structured Streaming.

Tick files landing in a folder are read as a stream, de-duplicated on the
tick id within the watermark, and aggregated into tumbling bars. In append
mode a bar is written once the watermark has passed its end, so late ticks
within the watermark are still counted and no bar is ever rewritten. Windows
that the watermark has not passed at the end of a bounded input are filled by
one batch over the rows from shortly before the last watermark.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def tick_stream(spark: SparkSession, source_dir: str, glob: str = "events*.parquet") -> DataFrame:
    # the pattern stands in the path, so that it also takes a table that is a folder of part files
    return _ticks(spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 16).parquet(os.path.join(source_dir, glob)))


def _ticks(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("asset"), F.col("ts").cast("timestamp").alias("ts"),
                         F.col("event_id").alias("tick_id"), (F.col("value") + 1.0).alias("price"),
                         F.lit(1.0).alias("volume"))


def streaming_bars(ticks: DataFrame, width: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    return _bars(ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["tick_id"]), width)


def _bars(t: DataFrame, width: str) -> DataFrame:
    order = F.struct("ts", "tick_id")
    return (t.groupBy("asset", F.window("ts", width).alias("w"))
             .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                  F.min("price").alias("low"), F.max_by("price", order).alias("close"),
                  F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks"))
             .select("asset", F.col("w.start").cast("timestamp_ntz").alias("bar_ts"),
                     "open", "high", "low", "close", "volume", "ticks"))


def open_bars(spark: SparkSession, source_dir: str, written: DataFrame, last: str | None, width: str = "1 hour",
              watermark: str = "2 hours", glob: str = "events*.parquet") -> DataFrame:
    """The bars that ``written`` lacks at the end of the input. Rows are read
    from a window and a watermark delay before ``last``, the stream's last
    watermark (all rows if there was none), so that copies of earlier ticks are
    still dropped."""
    ticks = _ticks(spark.read.schema(EVENTS_SCHEMA).parquet(os.path.join(source_dir, glob))).filter("ts IS NOT NULL")
    start = F.lit(last).cast("timestamp") - F.expr(f"INTERVAL {width}")
    if last:
        ticks = ticks.filter(F.col("ts") >= start - F.expr(f"INTERVAL {watermark}"))
    # the earliest copy of a tick counts; ticks without an id are one tick to the stream, too
    first = ticks.groupBy("tick_id").agg(F.min(F.struct("ts", "asset", "price", "volume")).alias("t")).select("tick_id", "t.*")
    bars = _bars(first, width)
    if last:
        bars = bars.filter(F.col("bar_ts").cast("timestamp") >= start)
    return bars.join(written.select("asset", "bar_ts"), (bars.asset.eqNullSafe(written.asset)) & (bars.bar_ts == written.bar_ts), "left_anti")


def run_available_now(spark: SparkSession, source_dir: str, width: str = "1 hour",
                      watermark: str = "2 hours") -> DataFrame:
    """Process every file present now, write the finished bars and then those
    still open as parquet under the shared checkpoint folder, return them all."""
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "stream-bars-" + uuid.uuid4().hex)
    out, rest, ckpt = (os.path.join(root, n) for n in ("bars", "open", "_checkpoint"))
    bars = streaming_bars(tick_stream(spark, source_dir), width, watermark)
    q = (bars.writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in p["eventTime"]]
    last = max(marks, default=None)
    written = spark.read.schema(bars.schema).parquet(out)
    open_bars(spark, source_dir, written, None if last is None or last.startswith("1970") else last, width, watermark).write.parquet(rest)
    return written.unionByName(spark.read.schema(bars.schema).parquet(rest))
