"""Melted periods and medians over a crosswalk against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantspark.operators.crosswalk import crosswalk_medians, melt_periods, period_columns


def test_melt(spark):
    df = spark.createDataFrame([("a", "x", "1.5", None), ("b", "y", "no", "7")], ["k", "name", "2024-02-29", "2023-12-31"])
    assert period_columns(df) == ["2023-12-31", "2024-02-29"]
    got = sorted((r.k, str(r.date), r.value) for r in melt_periods(df, ["k"]).collect())
    assert [g[:2] for g in got] == [("a", "2023-12-31"), ("a", "2024-02-29"), ("b", "2023-12-31"), ("b", "2024-02-29")]
    assert [g[2] for g in got] == [None, 1.5, 7.0, None]
    assert melt_periods(df.filter("k = 'z'"), ["k"]).count() == 0


@pytest.mark.parametrize("split", [5, 100_000])
def test_medians_equal_plain_join(spark, split):
    rng = np.random.default_rng(1)
    n = 900
    unit = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 6, n))  # a county with most rows
    v = pd.DataFrame({"u": unit, "y": rng.integers(2000, 2003, n), "x": np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 30, n) / 3)})
    v.loc[(v.u == 5) & (v.y == 2001), "x"] = np.nan
    cross = pd.DataFrame({"u": [1] * 8 + [2, 2, 3, 5, 9, 1], "z": [*range(8), 0, 20, 21, 22, 23, 3]})  # 4 has no ZIP, 9 no values; (1, 3) stands twice
    want = v.merge(cross, on="u").groupby(["z", "y"]).x.median()
    rows = [(int(a), int(b), None if np.isnan(c) else float(c)) for a, b, c in v.itertuples(index=False)] + [(None, 2000, 1.0)]
    values = spark.createDataFrame(rows, "u long, y int, x double").repartition(5)
    got = crosswalk_medians(values, "u", ["y"], "x", spark.createDataFrame([tuple(map(int, r)) for r in cross.itertuples(index=False)] + [(None, 99)], "u long, z long"), "z", split)
    mine = {(r.z, r.y): r.x for r in got.collect()}
    assert set(mine) == set(want.index) and mine[22, 2001] is None
    assert all(abs(mine[k] - x) < 1e-12 for k, x in want.items() if not np.isnan(x))
    assert crosswalk_medians(values.filter(F.lit(False)), "u", ["y"], "x", spark.createDataFrame([(1, 2)], "u long, z long"), "z").count() == 0
