"""Chunked (skew-safe) windows must equal the plain per-series windows."""

import datetime as dt

from pyspark.sql import functions as F

from quantspark.operators.asof import asof_join
from quantspark.operators.ordered import day_number, ordered_select, prefix_select, range_select, rolling


def _series(spark, n=400):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        for key in ("hot", "cold"):
            if key == "cold" and i % 7:
                continue
            v = None if i % 11 == 0 else float((i * 37) % 101)
            rows.append((key, base + dt.timedelta(hours=3 * i), i, v))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v double")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_halo_equals_direct(spark):
    df = _series(spark)

    def lvl(w):
        return [rolling(F.avg, "v", w, 5).alias("ma5"), F.lag("v", 3).over(w).alias("lag3"),
                F.lead("v", 2).over(w).alias("lead2"), F.sum("v").over(w.rowsBetween(1, 4)).alias("fwd4")]

    direct = ordered_select(df, ["k"], ["ts", "id"], [lvl], back=4, fwd=4)
    chunked = ordered_select(df, ["k"], ["ts", "id"], [lvl], back=4, fwd=4, chunk_rows=16, bucket=day_number("ts"))
    cols = ["k", "id", "ma5", "lag3", "lead2", "fwd4"]
    assert _rows(direct, cols) == _rows(chunked, cols)


def test_prefix_equals_direct(spark):
    df = _series(spark)
    specs = [("sum", "v", "s"), ("count", "v", "c"), ("sum_prior", "v", "sp"), ("count_prior", "v", "cp"),
             ("ffill", "v", "ff"), ("bfill", "v", "bf")]
    direct = prefix_select(df, ["k"], ["ts", "id"], specs)
    chunked = prefix_select(df, ["k"], ["ts", "id"], specs, chunk_rows=10, bucket=day_number("ts"))
    cols = ["k", "id", "s", "c", "sp", "cp", "ff", "bf"]
    assert _rows(direct, cols) == _rows(chunked, cols)


def test_range_halo_equals_direct(spark):
    df = _series(spark).withColumn("day", day_number("ts"))

    def lvl(w):
        return [F.count("v").over(w.rangeBetween(-7, -1)).alias("n7")]

    direct = range_select(df, ["k"], "day", [lvl], reach=7)
    chunked = range_select(df, ["k"], "day", [lvl], reach=7, bucket_width=9)
    assert _rows(direct, ["k", "id", "n7"]) == _rows(chunked, ["k", "id", "n7"])


def test_asof_strict_inclusive_and_buckets(spark):
    d = dt.date
    px = spark.createDataFrame([("A", d(2024, 1, 2), 1.0), ("A", d(2024, 1, 3), 2.0), ("A", d(2024, 1, 8), 3.0)],
                               "k string, pd date, p double")
    sig = spark.createDataFrame([("A", d(2024, 1, 3)), ("A", d(2024, 1, 5)), ("A", d(2024, 1, 9)), ("A", d(2024, 1, 1))],
                                "k string, sd date")
    for bw in (None, 2):
        strict = {r.sd: r.x_p for r in asof_join(sig, px, ["k"], "sd", "pd", ["p"], "forward", False, prefix="x_",
                                                bucket_width=bw).collect()}
        incl = {r.sd: r.x_p for r in asof_join(sig, px, ["k"], "sd", "pd", ["p"], "forward", True, prefix="x_",
                                              bucket_width=bw).collect()}
        back = {r.sd: r.x_p for r in asof_join(sig, px, ["k"], "sd", "pd", ["p"], "backward", True, prefix="x_",
                                              bucket_width=bw).collect()}
        assert strict == {d(2024, 1, 3): 3.0, d(2024, 1, 5): 3.0, d(2024, 1, 9): None, d(2024, 1, 1): 1.0}
        assert incl == {d(2024, 1, 3): 2.0, d(2024, 1, 5): 3.0, d(2024, 1, 9): None, d(2024, 1, 1): 1.0}
        assert back == {d(2024, 1, 3): 2.0, d(2024, 1, 5): 2.0, d(2024, 1, 9): 3.0, d(2024, 1, 1): None}


def test_asof_presence_keeps_null_cell(spark):
    d = dt.date
    q = spark.createDataFrame([("A", d(2024, 3, 31), 5.0), ("A", d(2024, 6, 30), None)], "k string, qd date, g double")
    m = spark.createDataFrame([("A", d(2024, 7, 31))], "k string, md date")
    r = asof_join(m, q, ["k"], "md", "qd", ["g"], "backward", prefix="q_").first()
    assert r.q_matched is True and r.q_g is None
