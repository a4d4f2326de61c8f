"""Permutation importance, saved bundles, look-ups and wide horizon reports."""

import pytest
from pyspark.sql import functions as F

from quantspark.operators import models as M
from quantspark.operators import scoring
from quantspark.operators.permutation import permutation_importance, shuffled
from quantspark.operators.scoring import Registry, fit_bundle, score_requests
from quantspark.plans.scoring import horizon_labels, horizon_returns, horizon_summary, look_up, ticker_prices
from quantspark.session import write_once


def test_every_repeat_is_a_permutation(spark):
    df = spark.range(300).select("id", (F.col("id") * 3).alias("x"))
    got = shuffled(df, ["x"], [F.col("id")], repeats=3).collect()
    ways = set()
    for k in (1, 2, 3):
        pairs = sorted((r.id, r._perm_x) for r in got if r.repeat == k)
        assert [p[0] for p in pairs] == list(range(300))
        assert sorted(p[1] for p in pairs) == [3 * i for i in range(300)]
        ways.add(tuple(p[1] for p in pairs))
    assert len(ways) == 3
    again = shuffled(df.repartition(5), ["x"], [F.col("id")], repeats=3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_importance_follows_the_model(spark):
    df = spark.range(400).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"))
    df = df.withColumn("y", 3 * F.col("a") + F.col("b"))
    model = M.pipeline(["a", "b", "c"], M.regressor("ridge", "y"), scale=False).fit(df)
    got = {r.feature: r for r in permutation_importance(model, df, ["a", "b", "c"], "y", [F.col("id")], repeats=20).collect()}
    assert all(r.repeats == 20 for r in got.values())
    # shuffling an independent uniform column adds w * sqrt(2 / 12) to an exact fit
    assert got["a"].importance == pytest.approx(3 * (1 / 6) ** 0.5, rel=0.1)
    assert got["b"].importance == pytest.approx((1 / 6) ** 0.5, rel=0.1)
    assert abs(got["c"].importance) < 1e-3 and got["a"].importance_std > 0


def test_importance_of_no_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, i) for i in range(9)], "a double, y double, id int")
    model = M.pipeline(["a"], M.regressor("ridge", "y"), scale=False).fit(df)
    assert permutation_importance(model, df.filter("id < 0"), ["a"], "y", [F.col("id")]).collect() == []


ROWS = "id int, ticker string, kind string, price double, y double"


def test_bundles_are_versioned_and_score_unseen_values(spark, tmp_path):
    rows = [(i, "AB"[i % 2], "PSX"[i % 3], float(i), 0.1 * i + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, ROWS)
    registry = Registry(spark, str(tmp_path / "models"))
    assert registry.versions("h") == []
    with pytest.raises(ValueError):
        registry.load("h")
    bundle = fit_bundle(df.filter("id < 45"), df.filter("id >= 45"), "y", "ticker", "kind", ["price"], "ridge")
    assert registry.save("h", bundle) == 1 and registry.save("h", bundle) == 2
    (tmp_path / "models" / "h" / "version=3").mkdir()  # a fit that broke off
    assert registry.versions("h") == [1, 2] and registry.save("h", bundle) == 4
    assert bundle[2].levels == ["S", "X"]
    asked = spark.createDataFrame([(1, "A", "P", 3.0), (2, "new", "other", None), (3, None, None, 4.0), (1, "A", "P", 3.0)],
                                  "id int, ticker string, kind string, price double")
    got = score_requests(asked, registry, {"30d": "h"}, ["id"]).orderBy("id").collect()
    assert [r.id for r in got] == [1, 1, 2, 3] and got[0] == got[1]
    mae = bundle[2].mae
    for r in got:
        assert r.confidence == pytest.approx(1 / (1 + mae / (abs(r.prediction) + 1e-9)))
        assert r.label == ("gain" if r.prediction > 0 else "loss")
    with pytest.raises(ValueError):
        registry.load("h", 3)


def test_no_labelled_rows_is_an_error(spark):
    df = spark.createDataFrame([(1, "A", "P", 1.0, None)], ROWS)
    with pytest.raises(ValueError):
        fit_bundle(df, df, "y", "ticker", "kind", ["price"])


def test_look_up(spark):
    t = spark.createDataFrame([(1, 2001, float("inf"), "UNDERPRICED"), (1, 2000, None, "OVERPRICED"), (2, 2000, 5.0, "Adequate"),
                               (3, 2000, float("nan"), "UNDERPRICED")], "zip int, year int, v double, Pricing_Category string")
    asked = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,)], "zip int")
    got = {r.zip: (r.found, r.year, r.v, r.classification) for r in look_up(t, asked, "zip", "year").collect()}
    assert got == {1: (True, 2000, 0.0, "Overpriced (Low Risk)"), 2: (True, 2000, 5.0, "Adequately Priced"),
                   3: (True, 2000, 0.0, "Underpriced (High Risk)"), 9: (False, None, None, None)}


def test_wide_report_has_a_row_over_all_tickers(spark):
    rows = [("A", 30, 1, 0.1, -0.1), ("A", 30, -1, 0.2, -0.2), ("A", 60, 1, None, None), ("B", 30, 1, 0.4, -0.4)]
    df = spark.createDataFrame(rows, "ticker string, horizon int, signal int, long_return double, short_return double")
    got = {r.ticker: r for r in horizon_summary(df).collect()}
    assert (got["A"].trades_30d, got["A"].win_rate_30d, got["A"].trades_60d, got["A"].avg_return_60d) == (2, 0.5, 0, None)
    assert got[None].is_total == 1 and got[None].trades_30d == 3 and got[None].avg_return_30d == pytest.approx(0.1)


def test_boosted_trees_are_fitted_on_cells_beyond_a_bound(spark, monkeypatch):
    """Few bins: cells stand for all rows, and give the trees that the rows give."""
    df = spark.range(6000).select(F.concat(F.lit("T"), F.col("id") % 3).alias("ticker"), F.element_at(F.array(*map(F.lit, "PSX")), (F.col("id") % 3 + 1).cast("int")).alias("kind"),
                                  (F.col("id") % 20).cast("double").alias("price"), F.when(F.col("id") % 7 > 0, F.floor(F.rand(3) * 5000).cast("double")).alias("qty"))
    df = write_once(df.withColumn("y", F.when(F.col("price") > 9, 2.0).otherwise(-1.0) + F.coalesce(F.col("qty"), F.lit(0.0)) / 5000 + F.rand(5)), "rows")
    sizes, cells = [], scoring.materialize
    monkeypatch.setattr(scoring, "materialize", lambda d: sizes.append(cells(d)) or sizes[-1])
    bundles = []
    for bound in (1 << 19, 2000):
        monkeypatch.setattr(scoring, "CELLS", bound)
        bundles.append(fit_bundle(df, df, "y", "ticker", "kind", ["price", "qty"]))
    assert bundles[0][2].levels == bundles[1][2].levels == ["S", "X"]
    got = sizes[-1]
    assert "_rows" in got.columns and got.count() < 5000
    assert got.agg(F.sum("_rows")).first()[0] == 6000  # no row is left out
    assert got.agg(F.sum(F.col("y") * F.col("_rows"))).first()[0] == pytest.approx(df.agg(F.sum("y")).first()[0], rel=1e-9)
    assert bundles[1][2].mae == pytest.approx(bundles[0][2].mae, rel=0.03)


def test_bins_part_all_values_or_quantiles(spark):
    df = spark.range(10000).select((F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(1.0).alias("one"))
    few, many, one = scoring.bin_edges(df, ["few", "many", "one"])
    assert few == [0.5, 1.5] and one == [] and len(many) == 31
    assert all(abs(e - 10000 * (i + 1) / 32) < 10 for i, e in enumerate(many))


def test_labels_of_trades_are_their_horizon_returns(spark, tmp_path):
    """One look-up per ticker and day gives what the look-up per trade gave; prices as ordered over all items."""
    day = "timestamp '2000-01-01' + make_dt_interval({})"
    spark.range(400).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey", "element_at(array('a', 'b', NULL), cast(id % 3 + 1 AS int)) AS o_orderpriority",
                                f"if(id % 11 = 0, NULL, {day.format('cast(id % 90 AS int)')}) AS o_orderdate", "100.0 * id AS o_totalprice").union(
        spark.range(1).selectExpr("7L", "7L", "'b'", day.format("7"), "700.0D")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1600).selectExpr("id % 400 AS l_orderkey", "cast(id % 2 AS int) AS l_linenumber", "1.0D + id % 13 AS l_quantity",
                                 "10.0D + id % 101 AS l_extendedprice", f"if(id % 17 = 0, NULL, {day.format('cast(id % 150 AS int)')}) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    li, o = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("lineitem", "orders"))
    price, order = F.col("l_extendedprice") / F.col("l_quantity"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    want = li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_orderpriority").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(
        F.min_by(price, order).alias("open"), F.max_by(price, order).alias("close"))
    got = ticker_prices(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.filter("ticker IS NULL OR date IS NULL").count() > 0
    per_trade = horizon_returns(spark, str(tmp_path)).groupBy("trade_id").pivot("horizon", [30, 60, 90]).agg(
        F.first("long_return").alias("ret"), F.first("exit_date").alias("exit"))
    labels = horizon_labels(spark, str(tmp_path))
    assert labels.columns == per_trade.columns
    assert sorted(map(str, labels.collect())) == sorted(map(str, per_trade.collect())) and labels.filter("`30_ret` IS NOT NULL").count() > 100
