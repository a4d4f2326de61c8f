"""Splits and metrics with hand-computed numbers, and null series keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantspark.operators import backtest as BT
from quantspark.operators import evaluation as EV
from quantspark.operators import events as EVT
from quantspark.operators.asof import asof_join
from quantspark.operators.ordered import number_rows, ordered_select, prefix_select


def test_expanding_folds_test_the_last_blocks(spark):
    df = spark.createDataFrame([(i, 23) for i in range(1, 24)], "pos long, n long")
    fold, _ = EV.expanding_fold("pos", "n", 5)
    got = [r.f for r in df.select("pos", fold.alias("f")).orderBy("pos").collect()]
    assert got == [None] * 8 + [f for f in range(1, 6) for _ in range(3)]
    few = spark.createDataFrame([(1, 3), (2, 3), (3, 3)], "pos long, n long")
    assert [r[0] for r in few.select(EV.expanding_fold("pos", "n", 5)[0]).collect()] == [None] * 3


@pytest.mark.parametrize("n,k,sizes", [(7, 5, [2, 2, 1, 1, 1]), (10, 5, [2] * 5), (3, 5, [1, 1, 1]), (23, 4, [6, 6, 6, 5])])
def test_k_fold_sizes(spark, n, k, sizes):
    rows = spark.range(1, n + 1).select(EV.k_fold("id", F.lit(n), k).alias("f")).groupBy("f").count().orderBy("f").collect()
    assert [r["count"] for r in rows] == sizes and [r.f for r in rows] == list(range(len(sizes)))


def test_direction_and_mean_error(spark):
    # moves of y: 0 (first), up, down, up; of p: 0 (first), up, up, up
    df = spark.createDataFrame([(1, "a", 1.0, 2.0), (2, "a", 3.0, 3.0), (3, "a", 2.0, 4.0), (4, "a", 5.0, 6.0),
                                (5, "a", None, 1.0), (1, "b", 1.0, 1.0)], "t int, k string, y double, p double")
    got = {r.k: r.direction_accuracy for r in EV.direction_accuracy(df, ["k"], "t", "y", "p").collect()}
    assert got == {"a": 0.75, "b": None}
    m = {r.k: r for r in EV.regression_metrics(df, ["k"], "y", "p").collect()}
    assert m["a"].mean_error == pytest.approx((1 + 0 + 2 + 1) / 4)


def test_overfit_score_is_the_mean_of_positive_gaps(spark):
    row = spark.createDataFrame([(1.0, 1.0, 0.9, 1.3, 0.8, 0.75)], "a double, b double, c double, d double, e double, f double")
    score, band = EV.overfit({"rmse": F.col("a"), "mae": F.col("b"), "r2": F.col("c")},
                             {"rmse": F.col("d"), "mae": F.col("e"), "r2": F.col("f")})
    got = row.select(score.alias("s"), band.alias("b")).first()
    assert got.s == pytest.approx((0.3 + 0 + 0.15) / 3, abs=1e-6) and got.b == "Mild"


def test_entry_without_exit_has_no_prices(spark):
    sig = spark.createDataFrame([(1, "x", 30, 0.5), (2, "x", 1, 0.5)], "id int, ticker string, horizon int, pred double").withColumn(
        "transaction_date", F.lit("2024-01-01").cast("date"))
    px = spark.createDataFrame([("x", "2024-01-02", 10.0, 11.0), ("x", "2024-01-03", 12.0, 13.0)],
                               "ticker string, d string, open double, close double").select(
        "ticker", F.col("d").cast("date").alias("date"), "open", "close")
    got = {r.id: r for r in BT.signal_returns(sig, px).collect()}
    assert got[1].entry_date is not None and got[1].entry_price is None and got[1].long_return is None
    assert got[2].entry_price == 10.0 and got[2].exit_price == 11.0


def test_null_keys_survive_chunking(spark):
    rows = [("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 3.0), (None, 2, 4.0), ("a", None, 5.0)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    order = [F.col("d"), F.col("v")]
    levels = [lambda w: [F.sum("v").over(w.rowsBetween(-1, Window.currentRow)).alias("s")]]

    def rows_of(x):
        return sorted(map(str, x.select("k", "d", "v", *[c for c in x.columns if c in ("s", "run", "_qs_rn")]).collect()))

    plain = ordered_select(df, ["k"], order, levels)
    assert rows_of(ordered_select(df, ["k"], order, levels, back=1, chunk_rows=2, bucket=F.col("d"))) == rows_of(plain)
    specs = [("sum", "v", "run")]
    assert rows_of(prefix_select(df, ["k"], order, specs, chunk_rows=1, bucket=F.col("d"))) == rows_of(prefix_select(df, ["k"], order, specs))
    assert number_rows(df, ["k"], order, F.col("d")).count() == 5 and number_rows(df, [], order, F.col("d")).count() == 5


def test_null_keys_keep_their_counts(spark):
    df = spark.createDataFrame([(None, 1, "p"), (None, 3, "q"), ("a", 3, "p")], "k string, day int, who string")
    prior = {(r.k, r.day): r.n for r in EVT.trailing_count(df, ["k"], "day", 5, "n").collect()}
    assert prior == {(None, 1): 0, (None, 3): 1, ("a", 3): 0}
    who = {(r.k, r.day): r.n for r in EVT.trailing_distinct(df, ["k"], "day", "who", 5, "n").collect()}
    assert who == {(None, 1): 0, (None, 3): 1, ("a", 3): 0}


def test_null_keys_as_of(spark):
    left = spark.createDataFrame([(None, 70), ("a", 70)], "k string, t int")
    right = spark.createDataFrame([(None, 1, 5.0), ("a", 2, 6.0)], "k string, t2 int, v double")
    wide, cut = ({(r.k): r.r_v for r in asof_join(left, right, ["k"], "t", "t2", ["v"], prefix="r_", axis="int", **o).collect()}
                 for o in ({}, {"bucket_width": 10}))
    assert wide == cut == {None: 5.0, "a": 6.0}


def test_search_folds_are_cut_on_the_rows_left(spark, monkeypatch):
    """27 train and validation rows in 3 folds: the first train block has 9 rows."""
    from quantspark.plans import selection as S
    n, seen = 32, []
    f = spark.range(n).select(F.lit("a").alias("asset"), (F.col("id") + 1).alias("pos"), F.lit(n).alias("n"),
                              F.when(F.col("id") < 27, "train").otherwise("test").alias("split"), F.rand(1).alias("target_vol_24h"))

    class Stop:
        def fit(self, train):
            seen.append(train.count())
            raise StopIteration

    monkeypatch.setattr(S, "_split_features", lambda *a: f)
    monkeypatch.setattr(S.M, "pipeline", lambda *a, **k: Stop())
    with pytest.raises((StopIteration, RuntimeError)):
        S.q_m10(spark, "")
    assert set(seen) <= {9, 15, 21} and 9 in seen
