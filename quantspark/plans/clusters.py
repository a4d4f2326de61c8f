"""Cluster classifiers and ordered category encodings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators import evaluation as EV
from quantspark.operators import models as M
from quantspark.operators.encoding import ordered_target_means, target_means
from quantspark.operators.mixtures import MODELS, binary_clusters, cluster_scores
from quantspark.operators.ranks import rank_rows
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.pairs import LAGS, pair_returns
from quantspark.session import materialize
from quantspark.sources.tables import table

TEST_SHARE = 0.25
PAIR_FEATURES = [f"{s}_lag_{k}" for s in ("btc_ret", "ret") for k in LAGS]
CATEGORIES = ["o_orderpriority", "c_mktsegment", "c_nationkey", "o_custkey"]
WEIGHT = 1.0
TRAIN_UNTIL = "2000-01-01"


def split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs' hours, the last quarter of each pair as test rows."""
    p = rank_rows(pair_returns(spark, sf_dir), ["asset"], [F.col("bar_ts")], "pos", "n")
    return materialize(p.withColumn("split", F.when(F.col("pos") <= F.floor(F.col("n") * (1 - TEST_SHARE)), "train").otherwise("test")))


def q_m8_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: k-means and a Gaussian mixture of the lagged returns as classifiers of
    the hour's direction, under both mappings, on train and test rows."""
    p = split_pairs(spark, sf_dir)
    out = None
    for kind in MODELS:
        s = cluster_scores(binary_clusters(kind, p.filter(F.col("split") == "train"), p, PAIR_FEATURES), "target_up").withColumn("model", F.lit(kind))
        out = s if out is None else out.unionByName(s)
    return round_doubles(out)


def large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's categories, a calendar split and the label:
    whether the total is over the mean of the training rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = table(spark, sf_dir, "orders")
    o = o.join(c, o.o_custkey == c.c_custkey, "left").withColumn(
        "split", F.when(F.col("o_orderdate") < F.lit(TRAIN_UNTIL).cast("timestamp"), "train").otherwise("test"))
    mean = o.filter(F.col("split") == "train").agg(F.avg(F.col("o_totalprice").cast("decimal(18,2)"))).first()[0]
    return o.select("o_orderkey", "o_orderdate", "split", *CATEGORIES, (F.col("o_totalprice") > F.lit(mean).cast("double")).cast("int").alias("large"))


def q_m6_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + C19: ordered target statistics of the training orders."""
    train = large_orders(spark, sf_dir).filter(F.col("split") == "train")
    return round_doubles(ordered_target_means(train, "o_orderkey", CATEGORIES, "large", ["o_orderdate"], WEIGHT))


def q_m6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: a boosted classifier on category columns, encoded by earlier training
    rows for the fit and by all training rows for the test; accuracy and AUC."""
    o = materialize(large_orders(spark, sf_dir))
    train, test = o.filter(F.col("split") == "train"), o.filter(F.col("split") == "test")
    cols = [f"{c}_te" for c in CATEGORIES]
    fit = ordered_target_means(train, "o_orderkey", CATEGORIES, "large", ["o_orderdate"], WEIGHT).join(train.select("o_orderkey", "large"), "o_orderkey")
    model = M.pipeline(cols, M.classifier("gbt", "large", len(cols))).fit(materialize(fit))
    seen = target_means(train, test, "o_orderkey", CATEGORIES, "large", WEIGHT).join(test.select("o_orderkey", "large"), "o_orderkey")
    s = model.transform(seen).select("large", F.col("prediction").cast("int").alias("yhat"), F.element_at(vector_to_array(F.col("probability")), 2).alias("score"))
    s = materialize(s.withColumn("model", F.lit("gbt_ordered_te")))
    return EV.classification_metrics(s, ["model"], "large", "yhat").join(EV.roc_auc(s, ["model"], "large", "score"), "model")


def _m6_sql() -> str:
    frame = "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    te = ", ".join(f"(coalesce(sum(large) OVER (PARTITION BY {c} {frame}), 0) + prior * {WEIGHT}) "
                   f"/ (count(*) OVER (PARTITION BY {c} {frame}) + {WEIGHT}) AS {c}_te" for c in CATEGORIES)
    return sql_round_select(f"""
WITH t AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '{TRAIN_UNTIL}'),
l AS (SELECT *, CAST(o_totalprice > (SELECT avg(o_totalprice) FROM t) AS INTEGER) AS large FROM t),
p AS (SELECT *, (SELECT avg(large) FROM l) AS prior FROM l)
SELECT o_orderkey, {te} FROM p""", ["o_orderkey"], [f"{c}_te" for c in CATEGORIES])


QUERIES = {"m8_pairs": q_m8_pairs, "m6": q_m6, "m6_encoded": q_m6_encoded}
ORACLE = {"m6_encoded": _m6_sql()}
