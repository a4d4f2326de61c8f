"""Ranks, quantiles, ROC curves and least squares against plain versions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantspark.operators import evaluation as EV
from quantspark.operators import linear, ranks, stats


@pytest.fixture(scope="module")
def hot():
    """One month with 90 % of the rows, many ties, null keys and values."""
    rng = np.random.default_rng(7)
    n = 4000
    month = np.where(rng.random(n) < 0.9, "m1", rng.choice(["m2", "m3", "m4"], n)).astype(object)
    month[rng.random(n) < 0.01] = None
    x = np.where(rng.random(n) < 0.3, 1.0, rng.integers(0, 500, n) / 7)
    x[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"id": range(n), "m": month, "x": x, "z": rng.normal(size=n), "y": rng.integers(0, 2, n)})


def _frame(spark, pdf):
    rows = [tuple(None if (isinstance(v, float) and math.isnan(v)) or v is None else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, m string, x double, z double, y int").repartition(6)


def test_rank_rows_equals_plain(spark, hot):
    got = ranks.rank_rows(_frame(spark, hot), ["m"], [F.desc("x"), F.col("id")]).toPandas().sort_values("id")
    for m, g in hot.groupby("m", dropna=False):
        mine = got[got.m.isna()] if m is None or m != m else got[got.m == m]
        order = g.assign(k=g.x.fillna(-np.inf)).sort_values(["k", "id"], ascending=[False, True])
        assert mine.set_index("id")["rank"].loc[order.id].tolist() == list(range(1, len(g) + 1)) and (mine.n == len(g)).all()


def test_running_totals_and_next_rows(spark, hot):
    got = ranks.running_totals(_frame(spark, hot).select("id", "m", "y"), ["m"], [F.col("id")], {"s": "y"}, {"i": "id"}).toPandas()
    for m, g in got.groupby("m", dropna=False):
        g = g.sort_values("id")
        assert g.s_before.tolist() == [0, *np.cumsum(g.y)[:-1]] and (g.s_all == g.y.sum()).all()
        assert g.i_next.iloc[:-1].astype(int).tolist() == g.id.iloc[1:].tolist() and g.i_next.isna().iloc[-1]
    every = ranks.running_totals(_frame(spark, hot).select("id", "y"), [], [F.col("id")], {"s": "y"}).toPandas().sort_values("id")
    assert every.s_before.tolist() == [0, *np.cumsum(hot.y)[:-1]]


def test_a_group_spans_ranges(spark, hot):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _frame(spark, hot)
        spread = df.repartitionByRange(8, "m", "x", "id").groupBy(F.spark_partition_id().alias("p"), "m").count().filter("m = 'm1'").collect()
        assert len(spread) > 4 and max(r["count"] for r in spread) < 0.4 * len(hot)
        got = ranks.rank_rows(df, ["m"], [F.col("x"), F.col("id")]).filter("m = 'm1'").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
        n = int((hot.m == "m1").sum())
        assert tuple(got) == (1, n, n)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_tie_ranks(spark, hot):
    got = ranks.with_tie_ranks(_frame(spark, hot), ["m"], {"rx": "x", "rz": "z"}).toPandas().sort_values("id")
    for c in ("x", "z"):
        want = hot.groupby("m", dropna=False)[c].rank(method="average")
        assert np.allclose(got[f"r{c}"].to_numpy(float), want.to_numpy(), equal_nan=True)


def test_group_quantiles(spark, hot):
    qs = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    got = ranks.group_quantiles(_frame(spark, hot), ["m"], ["x", "z"], qs).toPandas()
    assert len(got) == 2 * hot.m.nunique(dropna=False)
    for r in got.itertuples():
        g = hot[hot.m.isna()] if r.m is None or r.m != r.m else hot[hot.m == r.m]
        v = g[r.column].dropna()
        assert r.count == len(v) and np.allclose([getattr(r, f"q{i}") for i in range(len(qs))], np.quantile(v, qs), rtol=0, atol=1e-12)
    empty = _frame(spark, hot).filter(F.lit(False))
    assert ranks.group_quantiles(empty, ["m"], ["x"], qs).count() == 0 and ranks.rank_rows(empty, ["m"], [F.col("x")]).count() == 0
    one = ranks.group_quantiles(_frame(spark, hot.iloc[:1].assign(x=3.5)), [], ["x"], (0.3,)).first()
    assert one.q0 == 3.5


def test_winsor_and_z_keep_null_groups(spark, hot):
    df = stats.zscore_by(stats.winsorize_by(_frame(spark, hot), ["m"], ["z"], 0.05, 0.95), ["m"], ["z"])
    got = df.toPandas().sort_values("id")
    assert len(got) == len(hot)
    for m, g in hot.groupby("m", dropna=False):
        lo, hi = np.quantile(g.z, [0.05, 0.95])
        c = g.z.clip(lo, hi)
        assert np.allclose(got.set_index("id").z.loc[g.id], (c - c.mean()) / c.std())


def _curve(y, s):
    """Cumulative rates by falling score, without points between equal steps."""
    pts = [(t, sum((s >= t) & (y == 0)), sum((s >= t) & (y == 1))) for t in sorted(set(s), reverse=True)]
    f, t = np.array([p[1] for p in pts]), np.array([p[2] for p in pts])
    keep = [i for i in range(len(pts)) if i in (0, len(pts) - 1) or f[i + 1] - 2 * f[i] + f[i - 1] or t[i + 1] - 2 * t[i] + t[i - 1]]
    return [(None, 0.0, 0.0)] + [(pts[i][0], f[i] / f[-1], t[i] / t[-1]) for i in keep]


def test_roc_curve_and_auc(spark, hot):
    df = _frame(spark, hot)
    auc = {r.m: r for r in EV.roc_auc(df, ["m"], "y", "x").collect()}
    points = {}
    for r in EV.roc_curve(df, ["m"], "y", "x").collect():
        points.setdefault(r.m, []).append((r.threshold, r.fpr, r.tpr))
    for m, g in hot[hot.x.notna()].groupby("m", dropna=False):
        m = None if m is None or m != m else m
        y, s = g.y.to_numpy(), g.x.to_numpy()
        pairs = np.subtract.outer(s[y == 1], s[y == 0])
        assert abs(auc[m].roc_auc - ((pairs > 0) + 0.5 * (pairs == 0)).mean()) < 1e-12
        mine = sorted(points[m], key=lambda p: (p[0] is not None, -(p[0] or 0)))
        want = _curve(y, s)
        # a first point at no rate is dropped by neither
        assert [p[0] for p in mine] == [p[0] for p in want] and np.allclose(np.array([p[1:] for p in mine]), np.array([p[1:] for p in want]))
        fpr, tpr = np.array([p[1] for p in mine]), np.array([p[2] for p in mine])
        assert abs(np.sum(np.diff(fpr) * (tpr[1:] + tpr[:-1]) / 2) - auc[m].roc_auc) < 1e-12


def test_roc_of_one_class_and_no_rows(spark):
    one = spark.createDataFrame([("a", 0.5, 1), ("a", 0.7, 1), ("b", None, 0)], "k string, s double, y int")
    assert EV.roc_auc(one, ["k"], "y", "s").collect()[0].roc_auc is None
    assert all(r.fpr is None for r in EV.roc_curve(one, ["k"], "y", "s").collect())
    assert EV.roc_curve(one.filter("k = 'b'"), ["k"], "y", "s").count() == 0


def _plain_ols(x, y):
    x = np.c_[np.ones(len(x)), x]
    b = np.linalg.solve(x.T @ x, x.T @ y)
    r = y - x @ b
    df = len(y) - x.shape[1]
    se = np.sqrt(r @ r / df * np.diag(np.linalg.inv(x.T @ x)))
    return b, se, df, 1 - r @ r / ((y - y.mean()) ** 2).sum()


def test_ols_equals_normal_equations(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for k in ("a", "b", None):
        x = rng.normal(size=(60, 3)) + [1e6, 0, -5]  # a large mean costs no digits
        y = 3 + (x - [1e6, 0, -5]) @ [0.5, -2, 0] + rng.normal(size=60)
        want[k] = _plain_ols(x - x.mean(axis=0), y)
        rows += [(k, float(v), *map(float, r)) for v, r in zip(y, x)] + [(k, None, 0.0, 0.0, 0.0), (k, 1.0, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, y double, x1 double, x2 double, x3 double").repartition(5)
    got = linear.ols(df, ["k"], "y", ["x1", "x2", "x3"]).toPandas()
    for k, (b, se, dof, r2) in want.items():
        g = got[got.k.isna()] if k is None else got[got.k == k]
        g = g.set_index("term").loc[["x1", "x2", "x3"]]
        assert np.allclose(g.coef, b[1:], atol=1e-8) and np.allclose(g.std_err, se[1:], atol=1e-8)
        assert (g.df_resid == dof).all() and (g["n"] == 60).all() and np.allclose(g.r2, r2) and np.allclose(g.t_value, b[1:] / se[1:], atol=1e-6)


def test_collinear_columns_are_dropped(spark):
    rng = np.random.default_rng(2)
    day = rng.integers(0, 4, 200)
    rows = [(float(2 + d + e), float(v), *[int(d == i) for i in range(4)], 7.0) for d, v, e in zip(day, rng.normal(size=200), rng.normal(size=200) / 10)]
    df = spark.createDataFrame(rows, "y double, v double, d0 int, d1 int, d2 int, d3 int, c double")
    got = {r.term: r for r in linear.ols(df, [], "y", ["v", "d0", "d1", "d2", "d3", "c"]).collect()}
    assert got["d3"].coef is None and got["d3"].p_value is None and got["c"].coef is None and got["const"].rank == 5
    x = np.array([[r[1], *r[2:5]] for r in rows], float)
    b, se, dof, _ = _plain_ols(x, np.array([r[0] for r in rows]))
    assert np.allclose([got[t].coef for t in ("const", "v", "d0", "d1", "d2")], b) and np.allclose([got[t].std_err for t in ("const", "v", "d0", "d1", "d2")], se)
    assert got["v"].df_resid == dof == 195 and got["const"].std_err < 0.1


def test_ols_without_residual_degrees(spark):
    two = spark.createDataFrame([(1.0, 0.0), (3.0, 1.0)], "y double, x double")
    got = {r.term: r for r in linear.ols(two, [], "y", ["x"]).collect()}
    assert abs(got["x"].coef - 2) < 1e-12 and got["x"].std_err is None and got["x"].df_resid == 0
    assert linear.ols(two.filter("y > 9"), [], "y", ["x"]).count() == 0
    one = {r.term: r for r in linear.ols(two.limit(1), [], "y", ["x"]).collect()}
    assert one["x"].coef is None and one["const"].coef is not None


def test_student_t():
    for t, df, p in ((2.0, 10, 0.0733880348), (1.0, 1, 0.5), (12.706204736, 1, 0.05), (2.570581836, 5, 0.05), (1.959966357, 10**6, 0.05), (0.0, 3, 1.0)):
        assert abs(linear.t_two_sided(t, df) - p) < 1e-7
        assert linear.t_two_sided(-t, df) == linear.t_two_sided(t, df)
    assert linear.t_two_sided(math.inf, 5) == 0


def test_dummies_follow_the_training_rows(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("b",)], "k string")
    test = spark.createDataFrame([("c",), ("zz",), (None,), ("a",)], "k string")
    seen = linear.categories(train, "k")
    assert seen == ["a", "b", "c"]
    out = test.select("k", *linear.dummies("k", seen))
    assert out.columns == ["k", "k_b", "k_c"] and [tuple(r)[1:] for r in out.collect()] == [(0, 1), (0, 0), (0, 0), (0, 0)]
    assert len(linear.dummies("k", seen, drop_first=False)) == 3 and linear.dummies("k", []) == []
