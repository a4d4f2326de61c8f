"""Splits and metrics on the hourly feature table.

The evaluated forecast is the persistence baseline: next-24h volatility is
predicted by the current realised 24h volatility; the classifier score for
the extreme-volatility flag is the same quantity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators import evaluation as EV
from quantspark.operators import volatility as V
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.plans.crypto import _d1_sql, hourly_bars
from quantspark.session import write_once

FOLDS = 5


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = round_doubles(V.volatility_features(hourly_bars(spark, sf_dir)))
    w = Window.partitionBy("asset").orderBy("bar_ts")
    f = f.select("asset", "bar_ts", F.col("target_vol_24h").alias("y"), F.col("realized_vol_24h").alias("pred"),
                 F.col("target_extreme_vol_flag").alias("label"),
                 F.row_number().over(w).cast("long").alias("pos"), F.count(F.lit(1)).over(Window.partitionBy("asset")).alias("n"))
    # every caller reads it several times
    return write_once(f.withColumn("split", EV.chronological_split(f, "pos", "n")), "scored")


def q_e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    return s.groupBy("asset", "split").agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first_pos"),
                                           F.max("pos").alias("last_pos"))


def q_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 + V6: metrics per (asset, split) and the train-test overfit band."""
    m = EV.regression_metrics(scored(spark, sf_dir), ["asset", "split"], "y", "pred")
    names = ("rmse", "mae", "r2")
    tr = m.filter(F.col("split") == "train").select("asset", *[F.col(c).alias(f"_t_{c}") for c in names])
    m = m.join(tr, "asset", "left")
    score, band = EV.overfit({c: F.col(f"_t_{c}") for c in names}, {c: F.col(c) for c in names})
    return round_doubles(m.select("*", score.alias("overfit_score"), band.alias("overfit")).drop(*[f"_t_{c}" for c in names]))


def q_e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + V8 + V12: expanding folds, per-fold RMSE/MAE and return spread,
    then mean/std (population) over folds."""
    s = scored(spark, sf_dir)
    fold, size = EV.expanding_fold("pos", "n", FOLDS)
    s = s.withColumn("fold", fold).withColumn("fold_size", size).filter(F.col("fold").isNotNull())
    per = EV.regression_metrics(s, ["asset", "fold"], "y", "pred").select("asset", "fold", "n", "rmse", "mae")
    stats = s.groupBy("asset", "fold").agg(F.stddev_samp("y").alias("y_std"), F.avg("y").alias("y_mean"),
                                           F.first("fold_size").alias("fold_size"))
    per = per.join(stats, ["asset", "fold"])
    w = Window.partitionBy("asset")
    return round_doubles(per.select("*", F.avg("rmse").over(w).alias("cv_rmse_mean"),
                                    F.stddev_pop("rmse").over(w).alias("cv_rmse_std")))


def q_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 + V4 + V2: classification metrics of score > train 75th
    percentile, exact AUC, direction accuracy, on the test split."""
    s = scored(spark, sf_dir)
    thr = s.filter(F.col("split") == "train").groupBy("asset").agg(F.percentile("pred", 0.75).alias("thr"))
    t = s.filter(F.col("split") == "test").join(thr, "asset").withColumn("yhat", (F.col("pred") > F.col("thr")).cast("int"))
    cm = EV.classification_metrics(t, ["asset"], "label", "yhat")
    auc = EV.roc_auc(t, ["asset"], "label", "pred")
    dr = EV.direction_accuracy(t, ["asset"], "bar_ts", "y", "pred")
    return round_doubles(cm.join(auc, "asset").join(dr, "asset"))


def q_v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: corner points of the ROC curve per asset on the test split."""
    s = scored(spark, sf_dir)
    return round_doubles(EV.roc_curve(s.filter(F.col("split") == "test"), ["asset"], "label", "pred"))


def q_e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    s = s.withColumn("rsplit", EV.random_split(F.concat_ws("|", "asset", F.col("bar_ts").cast("string"))))
    return s.groupBy("rsplit").agg(F.count(F.lit(1)).alias("rows"))


# --- DuckDB oracles ---------------------------------------------------------

SQL_SCORED = f"""
SELECT asset, bar_ts, target_vol_24h AS y, realized_vol_24h AS pred, target_extreme_vol_flag AS label, pos, n,
  CASE WHEN pos <= floor(n * CAST({repr(0.7)} AS DOUBLE)) THEN 'train'
       WHEN pos <= floor(n * CAST({repr(0.7 + 0.15)} AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY bar_ts) AS pos, count(*) OVER (PARTITION BY asset) AS n
      FROM ({_d1_sql()}) d) x"""

SQL_E1 = f"SELECT asset, split, count(*) AS rows, min(pos) AS first_pos, max(pos) AS last_pos FROM ({SQL_SCORED}) s GROUP BY 1, 2"


def _metrics_sql(keys: str, src: str) -> str:
    return f"""SELECT {keys}, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
  1 - sum((y - pred) * (y - pred)) / nullif(var_pop(y) * count(*), 0) AS r2,
  avg(CASE WHEN y <> 0 THEN abs((y - pred) / y) END) * 100 AS mape, avg(pred - y) AS mean_error,
  quantile_cont(abs(y - pred), 0.5) AS median_ae, max(abs(y - pred)) AS max_error,
  sqrt(avg((y - pred) * (y - pred))) / nullif(avg(y), 0) AS rel_rmse, avg(abs(y - pred)) / nullif(avg(y), 0) AS rel_mae
FROM ({src}) s WHERE y IS NOT NULL AND pred IS NOT NULL GROUP BY {keys}"""


_MET = ["rmse", "mae", "r2", "mape", "mean_error", "median_ae", "max_error", "rel_rmse", "rel_mae"]
SQL_V1 = sql_round_select(f"""
WITH m AS ({_metrics_sql('asset, split', SQL_SCORED)}),
t AS (SELECT asset, rmse AS t_rmse, mae AS t_mae, r2 AS t_r2 FROM m WHERE split = 'train'),
g AS (SELECT m.*, (greatest((rmse - t_rmse) / (t_rmse + 1e-10), 0) + greatest((mae - t_mae) / (t_mae + 1e-10), 0)
                   + greatest(t_r2 - r2, 0)) / 3 AS overfit_score FROM m LEFT JOIN t USING (asset))
SELECT *, CASE WHEN overfit_score < 0.1 THEN 'None' WHEN overfit_score < 0.2 THEN 'Mild' WHEN overfit_score < 0.4 THEN 'Moderate'
       ELSE 'Severe' END AS overfit FROM g""", ["asset", "split", "n", "overfit"], _MET + ["overfit_score"])

SQL_E5 = sql_round_select(f"""
WITH z AS (SELECT *, floor(n / {FOLDS + 1}) AS fold_size FROM ({SQL_SCORED}) x),
s AS (SELECT *, CAST(floor((pos - 1 - (n - {FOLDS} * fold_size)) / nullif(fold_size, 0)) + 1 AS INTEGER) AS fold FROM z),
f AS (SELECT * FROM s WHERE fold BETWEEN 1 AND {FOLDS}),
m AS ({_metrics_sql('asset, fold', 'SELECT * FROM f')}),
st AS (SELECT asset, fold, stddev_samp(y) AS y_std, avg(y) AS y_mean, CAST(min(fold_size) AS BIGINT) AS fold_size
       FROM f GROUP BY 1, 2)
SELECT m.asset, m.fold, m.n, m.rmse, m.mae, st.y_std, st.y_mean, st.fold_size,
  avg(m.rmse) OVER (PARTITION BY m.asset) AS cv_rmse_mean, stddev_pop(m.rmse) OVER (PARTITION BY m.asset) AS cv_rmse_std
FROM m JOIN st USING (asset, fold)""", ["asset", "fold", "n", "fold_size"],
    ["rmse", "mae", "y_std", "y_mean", "cv_rmse_mean", "cv_rmse_std"])

SQL_V3 = sql_round_select(f"""
WITH s AS ({SQL_SCORED}),
th AS (SELECT asset, quantile_cont(pred, 0.75) AS thr FROM s WHERE split = 'train' GROUP BY 1),
t AS (SELECT s.*, CAST(pred > thr AS INTEGER) AS yhat FROM s JOIN th USING (asset) WHERE split = 'test'),
cm AS (SELECT asset, count(*) FILTER (WHERE label = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE label = 0 AND yhat = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE label = 0 AND yhat = 0) AS tn
       FROM t GROUP BY 1),
cm2 AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / nullif(tp + fp, 0) AS precision,
               tp / nullif(tp + fn, 0) AS recall FROM cm),
cm3 AS (SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM cm2),
r AS (SELECT asset, label, rank() OVER (PARTITION BY asset ORDER BY pred) + (count(*) OVER (PARTITION BY asset, pred) - 1) / 2.0 AS rk
      FROM t WHERE pred IS NOT NULL AND label IS NOT NULL),
au AS (SELECT asset, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg,
              (sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
              / nullif(count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0), 0) AS roc_auc FROM r GROUP BY 1),
dr0 AS (SELECT asset, y, pred, lag(y, 1, y) OVER w AS py, lag(pred, 1, pred) OVER w AS pp FROM t
        WHERE y IS NOT NULL AND pred IS NOT NULL WINDOW w AS (PARTITION BY asset ORDER BY bar_ts)),
dr AS (SELECT asset, CASE WHEN count(*) > 1 THEN avg(CAST(sign(pred - pp) = sign(y - py) AS DOUBLE)) END AS direction_accuracy,
              avg(CAST(sign(pred) = sign(y) AS DOUBLE)) AS sign_accuracy FROM dr0 GROUP BY 1)
SELECT * FROM cm3 JOIN au USING (asset) JOIN dr USING (asset)""",
    ["asset", "tp", "fp", "fn", "tn", "n_pos", "n_neg"],
    ["accuracy", "precision", "recall", "f1", "roc_auc", "direction_accuracy", "sign_accuracy"])

SQL_V4 = sql_round_select(f"""
WITH t AS (SELECT asset, pred, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM ({SQL_SCORED}) s
           WHERE split = 'test' AND pred IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, sum(p) OVER w AS tps, sum(q) OVER w AS fps, lag(p) OVER w AS p0, lead(p) OVER w AS p1, lead(q) OVER w AS q1,
             nullif(sum(p) OVER (PARTITION BY asset), 0) AS pp, nullif(sum(q) OVER (PARTITION BY asset), 0) AS qq
      FROM t WINDOW w AS (PARTITION BY asset ORDER BY pred DESC))
SELECT asset, pred AS threshold, fps / qq AS fpr, tps / pp AS tpr FROM c WHERE p0 IS NULL OR p1 IS NULL OR p1 <> p OR q1 <> q
UNION ALL SELECT DISTINCT asset, NULL, 0 / qq, 0 / pp FROM c""", ["asset"], ["threshold", "fpr", "tpr"])

QUERIES = {"v4": q_v4, "e1": q_e1, "v1": q_v1, "e5": q_e5, "v3": q_v3, "e8": q_e8}
ORACLE = {"v4": SQL_V4, "e1": SQL_E1, "v1": SQL_V1, "e5": SQL_E5, "v3": SQL_V3}
