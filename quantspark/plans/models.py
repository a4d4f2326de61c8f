"""Model training jobs on the feature tables.

Rows-only checks: fits are iterative and not SQL-expressible.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators import evaluation as EV
from quantspark.operators import models as M
from quantspark.operators import volatility as V
from quantspark.plans.crypto import hourly_bars
from quantspark.session import materialize
from quantspark.sources.tables import table

FEATURES = [f for f in V.FEATURES if f not in ("hour", "day_of_week", "week_of_year")]


def _split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = V.volatility_features(hourly_bars(spark, sf_dir))
    from pyspark.sql import Window
    w = Window.partitionBy("asset").orderBy("bar_ts")
    f = f.withColumn("pos", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("asset")))
    return materialize(f.withColumn("split", EV.chronological_split(f, "pos", "n")))


def q_m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2 + M3 + M9 + V1: three regressors of next-24h volatility,
    their equal-weight ensemble, metrics per (model, split)."""
    f = _split_features(spark, sf_dir)
    train = f.filter(F.col("split") == "train")
    n = train.count()
    scored = f.select("asset", "bar_ts", "split", "target_vol_24h", *FEATURES)
    for kind in ("gbt", "rf", "ridge"):
        model = M.pipeline(FEATURES, M.regressor(kind, "target_vol_24h", n_rows=n)).fit(train)
        scored = model.transform(scored).withColumnRenamed("prediction", f"pred_{kind}").drop("raw_features", "features")
    scored = scored.withColumn("pred_ensemble", M.ensemble(["pred_gbt", "pred_rf", "pred_ridge"]))
    long = scored.select("split", "target_vol_24h", F.explode(F.array(*[
        F.struct(F.lit(k).alias("model"), F.col(f"pred_{k}").alias("pred")) for k in ("gbt", "rf", "ridge", "ensemble")
    ])).alias("m")).select("split", "target_vol_24h", "m.model", "m.pred")
    return EV.regression_metrics(long, ["model", "split"], "target_vol_24h", "pred")


def q_m5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6 + C18 + V3 + V4: classifiers of the extreme-volatility flag
    with balanced class weights for the logistic model."""
    f = _split_features(spark, sf_dir)
    train = M.balanced_weights(f.filter(F.col("split") == "train"), "target_extreme_vol_flag")
    test = f.filter(F.col("split") == "test")
    out = None
    for kind in ("logistic", "rf", "gbt"):
        est = M.classifier(kind, "target_extreme_vol_flag", len(FEATURES), weight="weight" if kind == "logistic" else None)
        model = M.pipeline(FEATURES, est).fit(train)
        s = model.transform(test).select("target_extreme_vol_flag", F.col("prediction").cast("int").alias("yhat"),
                                         F.element_at(vector_to_array(F.col("probability")), 2).alias("score"),
                                         F.lit(kind).alias("model"))
        cm = EV.classification_metrics(s, ["model"], "target_extreme_vol_flag", "yhat")
        auc = EV.roc_auc(s, ["model"], "target_extreme_vol_flag", "score")
        r = cm.join(auc, "model")
        out = r if out is None else out.unionByName(r)
    return out


def q_m8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: k-means (k=2) on the embedding vectors, clusters mapped to labels."""
    e = table(spark, sf_dir, "embeddings").select(array_to_vector("embedding").alias("features"), "label")
    return M.kmeans_label_map(e, "features", "label", k=2)


def q_m12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + S11: gradient-boosted importances; the fitted pipeline is
    saved to the checkpoint folder and reloaded before reading them."""
    f = _split_features(spark, sf_dir).filter(F.col("split") == "train")
    model = M.pipeline(FEATURES, M.regressor("gbt", "target_vol_24h")).fit(f)
    path = os.path.join(spark.conf.get("spark.checkpoint.dir"), "models", "gbt_vol_24h")
    model.write().overwrite().save(path)
    return M.importances(PipelineModel.load(path), FEATURES, spark)


QUERIES = {"m1": q_m1, "m5": q_m5, "m8": q_m8, "m12": q_m12}
ORACLE: dict[str, str] = {}


def q_m7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + E11: multilayer perceptron classifier of the extreme flag, and
    a boosted classifier with an early-stopping validation subset (the
    validation split marks the rows)."""
    from pyspark.ml.classification import GBTClassifier
    f = _split_features(spark, sf_dir)
    train = f.filter(F.col("split") == "train")
    test = f.filter(F.col("split") == "test")
    out = None
    mlp = M.pipeline(FEATURES, M.classifier("mlp", "target_extreme_vol_flag", len(FEATURES))).fit(train)
    gbt_est = GBTClassifier(labelCol="target_extreme_vol_flag", featuresCol="features", maxIter=60, maxDepth=4,
                            validationIndicatorCol="is_val", validationTol=0.01, seed=42)
    tv = f.filter(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    gbt = M.pipeline(FEATURES, gbt_est).fit(tv)
    for name, model in (("mlp", mlp), ("gbt_early_stop", gbt)):
        s = model.transform(test).select("target_extreme_vol_flag", F.col("prediction").cast("int").alias("yhat"),
                                         F.lit(name).alias("model"))
        r = EV.classification_metrics(s, ["model"], "target_extreme_vol_flag", "yhat")
        out = r if out is None else out.unionByName(r)
    return out


def q_m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 + B2: surrogate revenue model trained on the simulated grid
    (state features + candidate rate -> revenue); its argmax rate per state
    is compared with the grid argmax."""
    from quantspark.operators import lending as L
    from quantspark.plans.lending import states
    g = materialize(L.revenue_grid(states(spark, sf_dir), ["asset", "bar_ts"], "realized_vol_24h", "volume_ratio_24h"))
    feats = ["vol", "volume_ratio", "rate"]
    model = M.pipeline(feats, M.regressor("gbt", "total_revenue"), scale=False).fit(g)
    scored = model.transform(g)
    surrogate = L.best_rate(scored.drop("total_revenue").withColumnRenamed("prediction", "total_revenue"),
                            ["asset", "bar_ts"]).withColumnRenamed("optimal_rate_hourly", "surrogate_rate")
    exact = L.best_rate(g, ["asset", "bar_ts"]).select("asset", "bar_ts", "optimal_rate_hourly")
    j = surrogate.join(exact, ["asset", "bar_ts"])
    return j.agg(F.count(F.lit(1)).alias("states"),
                 F.avg((F.col("surrogate_rate") == F.col("optimal_rate_hourly")).cast("double")).alias("exact_match_share"),
                 F.avg(F.abs(F.col("surrogate_rate") - F.col("optimal_rate_hourly"))).alias("mean_abs_rate_gap"))


def q_m14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + C6: attribution weights of the risk factors from boosted-tree
    importances, normalised to sum to one over the chosen factors."""
    from quantspark.plans.zip import RISK_FACTORS, risk_features
    d = risk_features(spark, sf_dir)
    model = M.pipeline(RISK_FACTORS, M.regressor("gbt", "Revenue_per_Exposure"), scale=False).fit(d)
    imp = M.importances(model, RISK_FACTORS, spark)
    tot = imp.agg(F.sum("importance")).first()[0] or 1.0
    return imp.withColumn("weight", F.col("importance") / F.lit(tot))


QUERIES.update({"m7": q_m7, "m15": q_m15, "m14": q_m14})
