"""Forecast paths: every step against a plain loop, weights against a fine grid, short series."""

import numpy as np
import pytest

from quantspark.operators.smoothing import DAMPING, FITTED, SIMPLE, best_weights, forecast_paths, smooth

XS = [10.0, 11.5, 11.0, 13.0, 14.2, 13.9, 16.0, 18.5, 18.0, 21.0]


def _loop(xs, kind, a, b, ahead):
    level = xs[0]
    trend = {"none": 0.0, "exponential": xs[1] / xs[0]}.get(kind, xs[1] - xs[0])
    damp = DAMPING if kind == "damped" else 1.0
    out = []
    for x in xs:
        guess = level * trend if kind == "exponential" else level + damp * trend
        out.append(guess)
        new = a * x + (1 - a) * guess
        if kind == "exponential":
            trend = b * new / level + (1 - b) * trend
        elif kind != "none":
            trend = b * (new - level) + (1 - b) * damp * trend
        level = new
    reach = 0.0
    for k in range(1, ahead + 1):
        reach += damp ** k
        out.append(level * trend ** k if kind == "exponential" else level + reach * trend)
    return out


@pytest.mark.parametrize("kind", ["none", "linear", "exponential", "damped"])
def test_steps_equal_a_plain_loop(kind):
    f, h, sse = smooth(np.array(XS), kind, np.array([0.3, 0.8]), np.array([0.2, 0.6]), 4)
    for j, (a, b) in enumerate(((0.3, 0.2), (0.8, 0.6))):
        want = _loop(XS, kind, a, b, 4)
        assert np.concatenate([f[:, j], h[:, j]]) == pytest.approx(want)
        assert sse[j] == pytest.approx(sum((x - y) ** 2 for x, y in zip(XS, want)))


@pytest.mark.parametrize("kind", ["none", "linear", "exponential", "damped"])
def test_weights_are_at_least_as_good_as_a_fine_grid(kind):
    a, b = best_weights(np.array(XS), kind)
    got = smooth(np.array(XS), kind, np.array([a]), np.array([b]), 0)[2][0]
    g = np.linspace(0, 1, 101)
    ga, gb = (v.ravel() for v in np.meshgrid(g, g if kind != "none" else np.zeros(1), indexing="ij"))
    assert got <= np.nanmin(smooth(np.array(XS), kind, ga, gb, 0)[2]) * (1 + 1e-6)


def test_paths_of_short_empty_and_zero_series(spark):
    rows = [("full", i, x, i < 7) for i, x in enumerate(XS)]
    rows += [("one", 0, 5.0, True), ("one", 1, 6.0, False), ("late", 0, 5.0, False), ("zero", 0, 0.0, True), ("zero", 1, 1.0, True),
             ("zero", 2, 2.0, False), ("gap", 0, 3.0, True), ("gap", 1, None, True), ("gap", 2, 4.0, False)]
    df = spark.createDataFrame(rows, "k string, t int, v double, tr boolean")
    got = {}
    for r in forecast_paths(df, "k", "t", "v", "tr").collect():
        got.setdefault((r.k, r.model), []).append((r.t, r.split, r.path))
    path = {k: [p for _, _, p in sorted(v)] for k, v in got.items()}
    assert len(got) == 5 * len({**SIMPLE, **FITTED})
    assert path["full", "ses_20"] == pytest.approx(_loop(XS[:7], "none", 0.2, 0, 3))
    assert [s for _, s, _ in sorted(got["full", "ses_20"])] == ["train"] * 7 + ["test"] * 3
    assert path["one", "ses_best"] == [5.0, 5.0] and path["one", "holt_linear"] == [None, None]
    assert path["late", "ses_50"] == [None] and path["zero", "holt_exponential"] == [None] * 3
    assert path["zero", "holt_linear"] == pytest.approx([1.0, 1.0, 2.0], abs=2) and path["gap", "ses_50"] == [3.0, 3.0]
    assert forecast_paths(df.filter("k = 'none'"), "k", "t", "v", "tr").collect() == []
