"""Two clusters as a classifier (M8): k-means or a Gaussian mixture, fitted by
MLlib on training rows without labels, with the clusters then named up or down.

Fits and scores are Spark jobs; only the counts of (split, cluster, label), at
most eight numbers, decide the names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.functions.numeric import binomial_moe

MODELS = ("kmeans", "gaussian_mixture")


def binary_clusters(kind: str, train: DataFrame, rows: DataFrame, features: Sequence[str], seed: int = 42) -> DataFrame:
    """``rows`` with ``cluster`` (0 or 1; for a mixture the likelier component)
    of a model of two clusters, fitted on the standardised ``train``."""
    if kind not in MODELS:
        raise ValueError(kind)
    options = {"k": 2, "seed": seed, "featuresCol": "_scaled", "predictionCol": "cluster"}
    model = KMeans(**options) if kind == "kmeans" else GaussianMixture(probabilityCol="_share", **options)
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
              StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True), model]
    return Pipeline(stages=stages).fit(train).transform(rows).drop("_raw", "_scaled", "_share")


def cluster_scores(df: DataFrame, label: str, split: str = "split", cluster: str = "cluster") -> DataFrame:
    """(mapping, flipped, split, n, accuracy, moe_95, precision, recall, f1), the scores of the clusters as
    predictions of the 0/1 ``label`` on 'train' and 'test' rows, under two mappings:

    * ``accuracy``: the one of the two that is right more often on the test rows
      (as they are on a tie), an upper bound;
    * ``up_fraction``: learned on train alone, the cluster with the larger share
      of ones is up (cluster 0 on a tie; an empty cluster has a share of 0)."""
    def n(s, c, y):
        return F.count_if((F.col(split) == s) & (F.col(cluster) == c) & (F.col(label) == y)).alias(f"{s}_{c}{y}")

    counts = df.agg(*[n(s, c, y) for s in ("train", "test") for c in (0, 1) for y in (0, 1)])

    def share(c):
        return F.coalesce(F.try_divide(F.col(f"train_{c}1"), F.col(f"train_{c}0") + F.col(f"train_{c}1")), F.lit(0.0))

    flips = {"accuracy": F.col("test_01") + F.col("test_10") > F.col("test_00") + F.col("test_11"), "up_fraction": share(0) >= share(1)}
    cases = []
    for mapping, flip in flips.items():
        for s in ("train", "test"):
            def pick(predicted, truth):
                return F.when(flip, F.col(f"{s}_{1 - predicted}{truth}")).otherwise(F.col(f"{s}_{predicted}{truth}"))
            cases.append(F.struct(F.lit(mapping).alias("mapping"), flip.alias("flipped"), F.lit(s).alias("split"), pick(1, 1).alias("tp"),
                                  pick(1, 0).alias("fp"), pick(0, 1).alias("fn"), pick(0, 0).alias("tn")))
    rows = counts.select(F.inline(F.array(*cases)))
    size = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    rows = rows.select("mapping", "flipped", "split", size.alias("n"), F.try_divide(F.col("tp") + F.col("tn"), size).alias("accuracy"),
                       precision.alias("precision"), recall.alias("recall"))
    return rows.select("mapping", "flipped", "split", "n", "accuracy", binomial_moe("accuracy", "n").alias("moe_95"), "precision", "recall",
                       F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)).alias("f1"))
