"""Queries that failed on the larger tables: results and how the work is cut."""

import datetime as dt
import pathlib
import random

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from quantspark.operators import ordered
from quantspark.plans import insider
from quantspark.plans.registry import oracle_sql


def _write(folder, **tables):
    for name, df in tables.items():
        df.to_parquet(f"{folder}/{name}.parquet", index=False, coerce_timestamps="us")
    return str(folder)


def _same(spark_df, sql, folder, tables, keys):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in tables:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want, got = con.execute(sql).df(), spark_df.toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    want, got = (d[cols].sort_values(keys).reset_index(drop=True) for d in (want, got))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=2e-6)


@pytest.fixture()
def trades(tmp_path):
    r = random.Random(7)
    day = dt.datetime(1995, 1, 1)
    customer = pd.DataFrame([(i, r.uniform(-900, 9000), r.choice(["BUILDING", "MACHINERY"]), r.randrange(25)) for i in range(20)],
                            columns=["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    orders = pd.DataFrame([(i, r.randrange(22), r.choice("OFP"), round(r.uniform(900, 400000), 2), day + dt.timedelta(days=r.randrange(500)),
                            r.choice(["1-URGENT", "2-HIGH", None])) for i in range(900)],
                          columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    lineitem = pd.DataFrame([(i, float(r.randrange(1, 50)), r.uniform(900, 90000), day + dt.timedelta(days=r.randrange(520))) for i in range(2500)],
                            columns=["l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    return _write(tmp_path, customer=customer, orders=orders, lineitem=lineitem)


def test_insider_rows_are_numbered_once_per_series(spark, trades, monkeypatch):
    calls = []

    def counted(df, keys, *rest):
        calls.append(tuple(keys))
        return ordered_number(df, keys, *rest)

    ordered_number = ordered.number_rows
    monkeypatch.setattr(ordered, "number_rows", counted)
    monkeypatch.setattr(insider, "number_rows", counted)
    out = insider.q_d8(spark, trades)
    assert sorted(calls) == [(), ("owner",), ("ticker",)]
    # null tickers meet no ticker in the oracle's USING join
    known = spark.read.parquet(f"{trades}/orders.parquet").filter("o_orderpriority is not null").selectExpr("o_orderkey as trade_id")
    want = f"SELECT * FROM ({insider.SQL_D8}) WHERE ticker IS NOT NULL"
    assert out.filter("ticker is null").count() > 0
    got = out.join(known, "trade_id", "left_semi")
    # positions and owners' records are over all rows: the oracle counts the null tickers out
    cols = ["trade_id", "value", "trade_conviction", "ownership_change_pct", "insider_cluster", "ticker_trade_count_30d", "price_momentum_30d", "spy_ma_dist"]
    _same(got.select(*cols), f"SELECT {', '.join(cols)} FROM ({want})", trades, ["customer", "orders", "lineitem"], ["trade_id"])


def test_insider_features_equal_the_oracle(spark, trades, tmp_path):
    orders = pd.read_parquet(f"{trades}/orders.parquet")
    orders["o_orderpriority"] = orders["o_orderpriority"].fillna("5-LOW")
    orders.to_parquet(f"{trades}/orders.parquet", index=False, coerce_timestamps="us")
    tables = ["customer", "orders", "lineitem"]
    _same(insider.q_d8(spark, trades), insider.SQL_D8, trades, tables, ["trade_id"])
    _same(E.queries()["b17"](spark, trades), oracle_sql()["b17"], trades, tables, ["models_agree"])




def test_nearest_line_meets_few_segments_of_a_dense_map(spark, monkeypatch):
    """Brute force agrees, and points do not meet all segments of a wide neighbourhood."""
    from pyspark.sql import functions as F

    from quantspark.operators import geo
    r = random.Random(3)
    points = [(i, r.uniform(-1, 3), r.uniform(-1, 4)) for i in range(60)] + [(60, 0.0, 0.0), (60, 0.0, 0.0)]
    lines = []
    for i in range(1500):
        x, y = r.uniform(0, 1), r.uniform(0, 1)
        lines.append((i, x, y, x + r.choice([0.0, r.uniform(-.05, .05)]), y + r.uniform(-.05, .05)))
    p, s = spark.createDataFrame(points, "pid long, lon double, lat double"), spark.createDataFrame(lines, "sid long, x1 double, y1 double, x2 double, y2 double")
    d = geo.point_segment_km(F.col("lon"), F.col("lat"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    want = {x["pid"]: tuple(x["b"]) for x in p.crossJoin(s).groupBy("pid").agg(F.min(F.struct(d.alias("d"), F.col("sid"))).alias("b")).collect()}
    met = []

    def staged(df, name):
        out = written(df, name)
        if name == "near-tiles":
            met.append(out.count())
        return out

    written = geo.write_once
    monkeypatch.setattr(geo, "write_once", staged)
    got = geo.nearest_line(p, s).collect()
    assert len(got) == 61
    assert {x["pid"]: (x["km_to_line"], x["nearest_sid"]) for x in got} == want
    assert met[-1] < 61 * 60


def test_region_pairs_are_not_deduplicated_with_their_polygons(spark):
    from quantspark.operators.geo import assign_regions
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    ev = spark.createDataFrame([(1, square(.5, .5, 3.0)), (1, square(.5, .5, 3.0)), (2, square(9.0, 9.0, .5))], "eid long, poly array<struct<x:double,y:double>>")
    re = spark.createDataFrame([(7, square(-1.0, -1.0, 3.5)), (8, square(1.2, 1.2, .3))], "rid long, rpoly array<struct<x:double,y:double>>")
    out = assign_regions(ev, re)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 7), (1, 7), (1, 8), (1, 8), (2, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "poly" in x]


def test_medians_meet_only_the_values_of_their_bin(spark, monkeypatch):
    from quantspark.operators import crosswalk
    r = random.Random(5)
    rows = [(r.randrange(4), 2000 + r.randrange(2), r.choice([None, round(r.uniform(0, 500), 1)])) for _ in range(4000)]
    cross = [(u, z) for u in range(5) for z in range(6) if (u + z) % 3] + [(1, 0), (1, 0), (None, 3)]
    seen = []

    def totals(df, keys, *rest):
        seen.append(df.count())
        return ranked(df, keys, *rest)

    ranked = crosswalk.running_totals
    monkeypatch.setattr(crosswalk, "running_totals", totals)
    got = crosswalk.crosswalk_medians(spark.createDataFrame(rows, "u long, y int, x double"), "u", ["y"], "x", spark.createDataFrame(cross, "u long, z long"), "z")
    f = pd.DataFrame(rows, columns=["u", "y", "x"]).merge(pd.DataFrame(cross, columns=["u", "z"]).dropna(), on="u")
    want = {k: v for k, v in f.groupby(["z", "y"]).x.median().items()}
    assert {(x["z"], x["y"]): x["x"] for x in got.collect()} == pytest.approx(want)
    assert seen[-1] < 200


def test_long_series_are_cut_and_short_ones_are_not(spark):
    """Series of many chunks, of one chunk and of null keys, on rows that keep their chunks."""
    from pyspark.sql import functions as F
    rows = [(k, i, float((i * 37) % 101) if i % 11 else None) for k, n in (("long", 300), ("short", 9), (None, 120)) for i in range(n)]
    df = ordered.number_rows(spark.createDataFrame(rows, "k string, i int, v double"), [], ["i", "k"], F.lit(0)).withColumnRenamed(ordered.ROW, "pos")
    df = ordered.cut_long_series(df, ["k"], "pos", 16)
    cuts = {r["k"]: (r["n"], r["most"]) for r in df.groupBy("k", ordered.CUT).count().groupBy("k").agg(F.count("*").alias("n"), F.max("count").alias("most")).collect()}
    assert cuts["short"] == (1, 9) and all(cuts[k][0] > 1 and cuts[k][1] <= 16 for k in ("long", None))

    def level(w):
        return [F.lag("v", 3).over(w).alias("lag3")]

    specs = [("sum", "v", "s"), ("sum_prior", "v", "sp"), ("count_prior", "v", "cp"), ("ffill", "v", "ff"), ("bfill", "v", "bf")]
    cut = ordered.number_rows(df, ["k"], ["i"], F.col(ordered.CUT))
    got = ordered.ordered_select(cut, ["k"], ["i"], [level], back=3, chunk_rows=16, numbered=True, keep=True)
    shuffles = got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k")
    w = got.select("*", F.sum("v").over(ordered.Window.partitionBy("k", ordered.CHUNK).orderBy(ordered.ROW)))
    assert w._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k") == shuffles
    got = ordered.prefix_select(got, ["k"], ["i"], specs, chunk_rows=16, numbered=True)
    want = ordered.prefix_select(ordered.ordered_select(df, ["k"], ["i"], [level], back=3), ["k"], ["i"], specs)
    cols = ["k", "i", "lag3", "s", "sp", "cp", "ff", "bf"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)


def test_insider_features_of_long_owners_equal_the_oracle(spark, trades, monkeypatch):
    orders = pd.read_parquet(f"{trades}/orders.parquet")
    orders["o_orderpriority"] = orders["o_orderpriority"].fillna("5-LOW")
    orders.to_parquet(f"{trades}/orders.parquet", index=False, coerce_timestamps="us")
    monkeypatch.setattr(insider, "CHUNK_ROWS", insider.MOMENTUM_ROWS)
    _same(insider.q_d8(spark, trades), insider.SQL_D8, trades, ["customer", "orders", "lineitem"], ["trade_id"])


def test_insider_features_leave_only_the_tables_still_read(spark, trades):
    from quantspark.session import ensure_checkpoint_dir
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = insider.q_d8(spark, trades)
    written = [p.name for p in set(folder.iterdir()) - before if p.name[-33] == "-"]  # besides Spark's own folders
    assert {x[:-33] for x in written} == {"by-owner", "ticker-days", "long-series"}
    assert out.count() == 720
