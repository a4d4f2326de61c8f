"""T1 against batch bars of the same ticks."""

from pyspark.sql import functions as F

from quantspark.plans.streaming import q_t1

SF = "/root/testdata/sf0.01"


def test_stream_bars_reach_the_end_of_input(spark):
    ticks = (spark.read.parquet(f"{SF}/events.parquet").dropDuplicates(["event_id"])
             .withColumn("bar_ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")))
    order = F.struct(F.col("ts").cast("timestamp"), "event_id")
    want = ticks.groupBy(F.col("event_type").alias("asset"), "bar_ts").agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", order).alias("close"), F.count(F.lit(1)).alias("ticks"))
    rows = {(r.asset, r.bar_ts): (r.open + 1, r.high + 1, r.low + 1, r.close + 1, r.ticks) for r in want.collect()}
    got = q_t1(spark, SF).collect()
    assert len(got) == len(rows)
    assert {(r.asset, r.bar_ts): (r.open, r.high, r.low, r.close, r.ticks) for r in got} == rows


def test_table_as_a_folder_of_part_files(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    key = ("asset", "bar_ts", "open", "close", "ticks")
    assert sorted(map(str, q_t1(spark, str(tmp_path)).select(*key).collect())) == sorted(map(str, q_t1(spark, SF).select(*key).collect()))
