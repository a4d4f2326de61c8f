"""Fitted and forecast paths of exponential smoothing.

A series is one value per period, so its length is bounded by the calendar; series
are folded side by side, one task per group of them, with numpy over all tried
weights at once. The level starts at the first value, the trend at the first change
(its ratio under the exponential trend), as the usual heuristic start has it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAMPING = 0.99
GRID_STEPS = 10
FINEST = 1e-4
# model: (kind of trend, fixed level weight or None for the best fit)
SIMPLE = {"ses_20": ("none", 0.2), "ses_50": ("none", 0.5)}
FITTED = {"ses_best": ("none", None), "holt_linear": ("linear", None), "holt_exponential": ("exponential", None),
          "holt_damped": ("damped", None)}


def smooth(x: np.ndarray, kind: str, alpha: np.ndarray, beta: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fitted [n, weights], forecast [ahead, weights], squared error [weights]) of one series."""
    ratio = kind == "exponential"
    damp = DAMPING if kind == "damped" else 1.0
    level = np.full(alpha.shape, x[0], dtype=float)
    start = 0.0 if kind == "none" else (x[1] / x[0] if ratio else x[1] - x[0])
    trend = np.full(alpha.shape, start, dtype=float)

    def step(k: float) -> np.ndarray:
        return level * trend ** k if ratio else level + k * trend

    fitted = np.empty((len(x), len(alpha)))
    with np.errstate(all="ignore"):
        for t, v in enumerate(x):
            fitted[t] = step(damp)
            new = alpha * v + (1 - alpha) * fitted[t]
            if kind != "none":
                trend = beta * (new / level if ratio else new - level) + (1 - beta) * damp * trend
            level = new
        reach = np.cumsum(damp ** np.arange(1, ahead + 1))
        forecast = np.array([step(k) for k in reach]).reshape(ahead, len(alpha))
        return fitted, forecast, ((fitted - x[:, None]) ** 2).sum(axis=0)


def best_weights(x: np.ndarray, kind: str) -> tuple[float, float] | None:
    """The weights of least squared error: a grid over [0, 1], then ever finer ones
    around its best point down to ``FINEST``; ties go to the smaller weights."""
    at, step, best = (0.5, 0.5), 0.5, None
    while step > FINEST / 2:
        sides = [np.unique(np.clip(c + np.linspace(-step, step, GRID_STEPS + 1), 0, 1)) for c in at]
        if kind == "none":
            sides[1] = np.zeros(1)
        a, b = (g.ravel() for g in np.meshgrid(*sides, indexing="ij"))
        sse = smooth(x, kind, a, b, 0)[2]
        if not np.isfinite(sse).any():
            return None
        i = int(np.nanargmin(np.where(np.isfinite(sse), sse, np.nan)))
        if best is None or sse[i] < best[0]:
            best = (sse[i], float(a[i]), float(b[i]))
        at, step = best[1:], step * 2 / GRID_STEPS
    return best[1:]


def series_paths(x: np.ndarray, kind: str, alpha: float | None, ahead: int) -> tuple[np.ndarray, float, float]:
    """(fitted values, then ``ahead`` forecasts; the weights). Nulls where the series is too
    short (no value; one value for a trend) or starts with 0 under the exponential trend."""
    none = np.full(len(x) + ahead, np.nan), np.nan, np.nan
    if len(x) < (1 if kind == "none" else 2) or (kind == "exponential" and x[0] == 0):
        return none
    weights = (alpha, 0.0) if alpha is not None else best_weights(x, kind)
    if weights is None:
        return none
    fitted, forecast, _ = smooth(x, kind, np.array([weights[0]]), np.array([weights[1]]), ahead)
    return np.concatenate([fitted[:, 0], forecast[:, 0]]), weights[0], np.nan if kind == "none" else weights[1]


def forecast_paths(values: DataFrame, key: str, period: str, value: str, is_train: str,
                   models: Mapping[str, tuple[str, float | None]] = {**SIMPLE, **FITTED}) -> DataFrame:
    """(key, model, period, split, value, path, alpha, beta): per model one row per period,
    its one-step fit on the train periods and its forecast on all later ones. Periods
    must be unique per key; those without a value are left out."""
    d = values.filter(F.col(value).isNotNull()).select(key, period, F.col(value).cast("double").alias("value"), F.col(is_train).alias("_train"))
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    cols: Sequence[str] = [key, "model", period, "split", "value", "path", "alpha", "beta"]
    schema = f"{key} {types[key]}, model string, {period} {types[period]}, split string, value double, path double, alpha double, beta double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_train", period], ascending=[False, True])
        x = pdf.loc[pdf["_train"], "value"].to_numpy(dtype=float)
        out = []
        for name, (kind, alpha) in models.items():
            path, a, b = series_paths(x, kind, alpha, len(pdf) - len(x))
            path = np.where(np.isfinite(path), path, np.nan)
            out.append(pdf.assign(model=name, path=path, alpha=a, beta=b, split=np.where(pdf["_train"], "train", "test")))
        res = pd.concat(out)[list(cols)]
        return res.astype({c: object for c in ("path", "alpha", "beta")}).where(res.notna(), None)
    return d.groupBy(key).applyInPandas(run, schema)
