"""Ordered target statistics, cluster classifiers, running products and latest values against plain versions."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantspark.operators.encoding import ordered_target_means, target_means
from quantspark.operators.latest import growth, latest_valid, slope, with_previous_valid
from quantspark.operators.mixtures import binary_clusters, cluster_scores
from quantspark.operators.ranks import running_product


def test_ordered_means_see_earlier_rows_only(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(0, 40)), None if i % 50 == 7 else str(rng.choice(["hot"] * 9 + ["a", "b"])), int(rng.integers(0, 2)) if i % 11 else None)
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, t int, k string, y int").repartition(7)
    got = {r.id: r.k_te for r in ordered_target_means(df, "id", ["k"], "y", ["t"], 2.0).collect()}
    known = [r[3] for r in rows if r[3] is not None]
    prior, seen = sum(known) / len(known), {}
    for i, _, k, y in sorted(rows, key=lambda r: (r[1], r[0])):
        s, n = seen.get(k, (0, 0))
        assert abs(got[i] - (s + 2 * prior) / (n + 2)) < 1e-12
        if y is not None:
            seen[k] = (s + y, n + 1)
    # a row's own label changes no statistic of its own
    first = min(rows, key=lambda r: (r[1], r[0]))[0]
    assert abs(got[first] - prior) < 1e-12


def test_target_means_of_new_rows(spark):
    train = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "a", 0), (4, None, 1), (5, "c", None)], "id long, k string, y int")
    rows = spark.createDataFrame([(10, "a"), (11, None), (12, "new"), (13, "c")], "id long, k string")
    got = {r.id: r.k_te for r in target_means(train, rows, "id", ["k"], "y").collect()}
    assert got[10] == pytest.approx(1 / 3) and got[11] == 1.0 and got[12] == 0.5 and got[13] == 0.5
    none = target_means(train.filter("id > 9"), rows, "id", ["k"], "y").collect()
    assert all(r.k_te is None for r in none) and target_means(train, rows.filter("id > 99"), "id", ["k"], "y").count() == 0


def _counts(spark, table):
    """Rows from (split, cluster, label, count)."""
    return spark.createDataFrame([(s, c, y) for s, c, y, n in table for _ in range(n)], "split string, cluster int, up int")


def test_mappings(spark):
    # cluster 0 is mostly up on train, cluster 1 on test
    df = _counts(spark, [("train", 0, 1, 6), ("train", 0, 0, 2), ("train", 1, 1, 1), ("train", 1, 0, 5),
                         ("test", 0, 1, 1), ("test", 0, 0, 4), ("test", 1, 1, 3), ("test", 1, 0, 2)])
    got = {(r.mapping, r.split): r for r in cluster_scores(df, "up").collect()}
    a, u = got["accuracy", "test"], got["up_fraction", "test"]
    assert not a.flipped and a.accuracy == 0.7 and a.precision == 0.6 and a.recall == 0.75 and a.n == 10
    assert u.flipped and u.accuracy == pytest.approx(0.3) and u.precision == 0.2 and u.recall == 0.25
    assert got["up_fraction", "train"].accuracy == 11 / 14 and a.moe_95 == pytest.approx(1.96 * math.sqrt(0.7 * 0.3 / 10))


def test_mappings_of_an_empty_cluster(spark):
    df = _counts(spark, [("train", 1, 1, 4), ("train", 1, 0, 4), ("test", 1, 0, 3)])
    got = {(r.mapping, r.split): r for r in cluster_scores(df, "up").collect()}
    # the empty cluster has a share of nothing, so cluster 1 is up
    assert not got["up_fraction", "test"].flipped and got["up_fraction", "test"].accuracy == 0 and got["up_fraction", "test"].f1 == 0
    assert got["accuracy", "test"].flipped and got["accuracy", "test"].accuracy == 1
    assert all(r.accuracy is None for r in cluster_scores(df.filter(F.lit(False)), "up").collect())


def test_mixture_separates_what_distance_cannot(spark):
    """A tight and a wide group with one centre: only the mixture tells them apart."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        wide = i % 2
        x = rng.normal(scale=6.0 if wide else 0.4, size=2)
        rows.append((i, "train" if i < 900 else "test", float(x[0]), float(x[1]), int(wide)))
    df = spark.createDataFrame(rows, "id long, split string, a double, b double, up int")
    acc = {}
    for kind in ("kmeans", "gaussian_mixture"):
        got = cluster_scores(binary_clusters(kind, df.filter("split = 'train'"), df, ["a", "b"]), "up").filter("mapping = 'up_fraction' and split = 'test'").first()
        acc[kind] = got.accuracy
    assert acc["gaussian_mixture"] > 0.9 > 0.75 > acc["kmeans"]
    with pytest.raises(ValueError):
        binary_clusters("other", df, df, ["a"])


def test_running_product(spark):
    rng = np.random.default_rng(5)
    series = {"a": [1.1, None, 0.9, -0.5, -2.0, 1.0], "b": [None, None, 2.0, 0.0, 3.0], "c": (1 + rng.normal(size=200) / 50).tolist(), None: [2.0, 2.0]}
    rows = [(k, i, v) for k, xs in series.items() for i, v in enumerate(xs)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges per series
    try:
        got = running_product(spark.createDataFrame(rows, "k string, i int, f double"), ["k"], [F.col("i")], "f").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for k, xs in series.items():
        mine = (got[got.k.isna()] if k is None else got[got.k == k]).sort_values("i")["product"].to_numpy(float)
        s = pd.Series(xs, dtype=float)
        want = s.fillna(1.0).cumprod().where(s.notna().cumsum() > 0)
        assert np.allclose(mine, want, equal_nan=True, rtol=1e-10)


def test_latest_values_slopes_and_growth(spark):
    d = [dt.date(2024, m, 1) for m in range(1, 6)]
    rows = [("x", d[0], 10.0, 1.0), ("x", d[1], None, 2.0), ("x", d[2], 12.0, None), ("x", d[3], 15.0, None), ("y", d[4], None, 5.0), ("y", d[0], 0.0, None),
            ("y", d[1], 4.0, None), ("z", d[0], None, None)]
    df = spark.createDataFrame(rows, "k string, d date, a double, b double")
    got = {r.k: r for r in latest_valid(df, "k", "d", ["a", "b"]).collect()}
    assert (got["x"].a, got["x"].a_age, got["x"].b, got["x"].b_age) == (15.0, 30, 2.0, 90)
    assert (got["y"].a, got["y"].a_age, got["y"].b, got["y"].b_age) == (4.0, 90, 5.0, 0) and got["z"].a is None and got["z"].a_age is None
    s = {r.k: (r.s, r.t) for r in df.groupBy("k").agg(slope("a", "d").alias("s"), slope("b", "d").alias("t")).collect()}
    assert s["x"] == (0.5, 1.0) and s["y"] == (None, None) and s["z"] == (None, None)  # from nothing, from one value
    g = {r.k: r.g for r in with_previous_valid(df, "k", "d", ["a"]).groupBy("k").agg(growth("a", "d").alias("g")).collect()}
    assert g == {"x": 0.25, "y": None, "z": None}
