"""Latest row inside a window, else the latest of all; D3 in chunks."""

import datetime as dt

from quantspark.plans.portfolio import latest_in_window


def test_latest_in_window(spark):
    d = dt.date
    rows = [("a", d(2024, 1, 5), 1), ("a", d(2024, 1, 9), 2), ("a", d(2024, 1, 9), 3), ("a", d(2024, 3, 1), 4),
            ("b", d(2023, 1, 1), 5), ("b", d(2024, 2, 1), 6), ("c", None, 7), (None, d(2024, 1, 31), 8), (None, None, 9)]
    df = spark.createDataFrame(rows, "k string, d date, id int")
    got = {r.k: (r.id, r.in_window) for r in latest_in_window(df, ["k"], "d", ["id"], "2024-01-01", "2024-01-31").collect()}
    assert got == {"a": (3, True), "b": (6, False), "c": (7, False), None: (8, True)}
    assert latest_in_window(df.filter("id > 99"), ["k"], "d", ["id"], "2024-01-01", "2024-01-31").collect() == []


def test_pair_features_do_not_depend_on_chunks(spark, monkeypatch):
    from quantspark.plans import pairs
    plain = sorted(map(str, pairs.pair_features(spark, "/root/testdata/sf0.01").collect()))
    monkeypatch.setattr(pairs, "CHUNK_ROWS", 80)
    assert plain and sorted(map(str, pairs.pair_features(spark, "/root/testdata/sf0.01").collect())) == plain
