"""MLlib training and scoring jobs.

Each model family is an MLlib estimator inside a Pipeline so that fitting
is distributed and the fitted artefact (assembler + scaler + model) saves
and loads as one ``PipelineModel``. Numeric equality with the source's
single-machine libraries is not a goal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def regressor(kind: str, label: str, seed: int = 42, n_rows: int | None = None, weight: str | None = None):
    if kind == "gbt":          # M1 (LightGBM / XGBoost stand-in)
        kw = {"weightCol": weight} if weight else {}
        return GBTRegressor(labelCol=label, featuresCol="features", maxDepth=4, maxIter=50, stepSize=0.05,
                            subsamplingRate=0.8, seed=seed, **kw)
    if kind == "rf":           # M2
        return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=50, maxDepth=8, seed=seed)
    if kind == "ridge":        # M3: sklearn alpha=10 is summed, MLlib regParam is averaged
        reg = 10.0 / n_rows if n_rows else 0.0
        return LinearRegression(labelCol=label, featuresCol="features", regParam=reg, elasticNetParam=0.0)
    raise ValueError(kind)


def classifier(kind: str, label: str, n_features: int, seed: int = 42, weight: str | None = None):
    if kind == "logistic":     # M5
        kw = {"weightCol": weight} if weight else {}
        return LogisticRegression(labelCol=label, featuresCol="features", regParam=0.01, maxIter=100, **kw)
    if kind == "rf":           # M6
        return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=50, maxDepth=6, seed=seed)
    if kind == "gbt":          # M6
        return GBTClassifier(labelCol=label, featuresCol="features", maxDepth=4, maxIter=40, seed=seed)
    if kind == "mlp":          # M7
        return MultilayerPerceptronClassifier(labelCol=label, featuresCol="features",
                                              layers=[n_features, 32, 16, 2], seed=seed, maxIter=100)
    raise ValueError(kind)


def pipeline(features: Sequence[str], estimator, scale: bool = True) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    else:
        stages[0].setOutputCol("features")
    stages.append(estimator)
    return Pipeline(stages=stages)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """N / (k * n_class) per row, from one grouped count (k rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    k = counts.count()
    n = df.count()
    return df.join(counts, label).withColumn(out, F.lit(float(n)) / (k * F.col("_nc"))).drop("_nc")


def importances(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Feature importances (trees) or coefficients (linear), ranked by
    absolute value."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    elif hasattr(est, "coefficients"):
        vals = est.coefficients.toArray().tolist()
    else:
        vals = [None] * len(features)
    rows = sorted(zip(features, vals), key=lambda r: -abs(r[1] or 0.0))
    return spark.createDataFrame([(f, float(v) if v is not None else None, i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def kmeans_label_map(df: DataFrame, features_col: str, label: str, k: int = 2, seed: int = 42) -> DataFrame:
    """M8: k-means, then each cluster takes the majority label of its
    members (mapping by accuracy); returns per-cluster sizes and accuracy."""
    km = KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol="cluster").fit(df)
    scored = km.transform(df)
    by = scored.groupBy("cluster", label).agg(F.count(F.lit(1)).alias("n"))
    best = by.groupBy("cluster").agg(F.max_by(label, F.struct("n", -F.col(label))).alias("mapped_label"),
                                     F.sum("n").alias("size"), F.max("n").alias("correct"))
    return best.withColumn("cluster_accuracy", F.col("correct") / F.col("size"))


def ensemble(preds: Sequence[str], weights: Sequence[float] | None = None):
    """M9: weighted mean of prediction columns (equal weights by default)."""
    w = list(weights) if weights else [1.0] * len(preds)
    tot = sum(w)
    expr = F.lit(0.0)
    for p, wi in zip(preds, w):
        expr = expr + F.col(p) * (wi / tot)
    return expr
