"""B25 trends, V9's baseline error and B28's scenarios."""

import pytest
from pyspark.sql import functions as F

from quantspark.plans.portfolio import ALPHA_GRID, DAMPING, smoothing_forecasts
from quantspark.plans.sampling import COLLATERALS, LEVERAGES, POSITIONS, q_b28
from quantspark.plans.strategies import baseline_error

SF = "/root/testdata/sf0.01"


def _holt(xs, kind, h):
    """Forecasts of all weights with their SSE, smallest first."""
    fits = []
    for a in ALPHA_GRID:
        for b in ALPHA_GRID:
            level, trend, sse, damp = xs[1], xs[1] / xs[0] if kind == "exponential" else xs[1] - xs[0], 0.0, DAMPING if kind == "damped" else 1.0
            for x in xs[2:]:
                guess = level * trend if kind == "exponential" else level + damp * trend
                new = a * x + (1 - a) * guess
                trend = b * (new / level if kind == "exponential" else new - level) + (1 - b) * damp * trend
                level, sse = new, sse + (x - guess) ** 2
            end = level * trend ** h if kind == "exponential" else level + sum(damp ** k for k in range(1, h + 1)) * trend
            fits.append((sse, a, b, end))
    return min(fits)[-1]


def test_holt_trends(spark):
    xs = {"p": [10.0, 11.5, 11.0, 13.0, 14.2, 13.9, 16.0, 18.5], "q": [5.0, 4.0, 4.5, 3.0, 3.5, 2.0]}
    rows = [(k, i, x) for k, v in xs.items() for i, x in enumerate(v)]
    for r in smoothing_forecasts(spark.createDataFrame(rows, "k string, i int, x double"), "k", "i", "x").collect():
        for kind in ("linear", "exponential", "damped"):
            assert r[f"holt_{kind}_forecast_5"] == pytest.approx(_holt(xs[r.k], kind, 5))


def test_train_mean_baseline(spark):
    rows = [("train", 1.0, None), ("train", 3.0, None), ("test", 4.0, 3.0), ("test", 1.0, 1.5), ("test", None, 9.0), ("val", 9.0, 0.0)]
    r = baseline_error(spark.createDataFrame(rows, "split string, y double, p double"), "y", "p").first()
    assert (r.n_train, r.train_mean, r.n_test, r.mae, r.baseline_mae, r.improvement_pct) == (2, 2.0, 2, 0.75, 1.5, 50.0)


def test_scenarios(spark):
    rows = q_b28(spark, SF).collect()
    assert len(rows) == 5 and rows == q_b28(spark, SF).collect()
    assert all(r.position in POSITIONS and r.leverage in LEVERAGES and r.collateral in COLLATERALS for r in rows)
    assert all(r.volume_ratio is not None for r in rows)


def test_short_series_have_no_trend(spark):
    df = spark.createDataFrame([("one", 1, 5.0), ("two", 1, 5.0), ("two", 2, 6.0)], "k string, t int, v double")
    got = {r.k: r.asDict() for r in smoothing_forecasts(df, "k", "t", "v").collect()}
    assert set(got) == {"one", "two"} and sum(v is None for v in got["one"].values()) > sum(v is None for v in got["two"].values())
