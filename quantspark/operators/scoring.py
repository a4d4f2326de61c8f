"""Batch scoring from saved models (M11): a registry of fitted bundles, one per
(name, version), in a folder that driver and executors share.

A bundle is a fitted pipeline, the target means of a category column, the levels
of a dummy column, the order of the features and the error on held-out rows.
Versions are never overwritten: a new fit takes the next number, and scoring
loads the latest complete one or the one it is asked for.

Boosted trees pass over their rows some 200 times, but see of a row only the bin
of each feature and the label. Beyond ``CELLS`` rows they are fitted on cells (equal bins)
with the label's mean, weighted by their rows: every split has the same gain and every
leaf the same mean as on the rows, and the passes grow with the bins, not with the rows.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators import models as M
from quantspark.session import materialize

# Rows up to which boosted trees are fitted on rows, and about the number of weighted
# cells beyond (more if the bins have more combinations).
CELLS = 1 << 19
BINS = 32  # MLlib's maxBins
GRID = 128 * BINS


@dataclass(frozen=True)
class Facts:
    """What a bundle knows beside its pipeline and its category means."""
    category: str
    dummy: str
    levels: list[str]
    numbers: list[str]
    features: list[str]
    global_mean: float
    mae: float | None


def encode(rows: DataFrame, means: DataFrame, facts: Facts) -> DataFrame:
    """``rows`` with the bundle's features. A category that training did not hold takes the
    global mean, a level that it did not hold has no dummy, missing numbers are 0."""
    joined = rows.join(means.select(F.col("category").alias(facts.category), "_mean"), facts.category, "left")
    flags = [F.coalesce((F.col(facts.dummy) == v).cast("double"), F.lit(0.0)).alias(f"is_{v}") for v in facts.levels]
    return joined.select(*rows.columns, F.coalesce("_mean", F.lit(facts.global_mean)).alias("_category_mean"),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_{c}") for c in facts.numbers], *flags)


def bin_edges(rows: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Per column its thresholds, as MLlib's trees take them: between all values, where there
    are at most ``bins``, else between quantiles. All rows count; a value rarer than 1 in ``GRID`` may share a bin."""
    out = []
    for found in rows.approxQuantile(list(columns), [i / GRID for i in range(GRID + 1)], 1 / (2 * GRID)):
        values = sorted({v for v in found if math.isfinite(v)})
        if len(values) <= bins:
            below = values[:-1]
        else:
            below = sorted({found[i * len(found) // bins] for i in range(1, bins)} & set(values[:-1]))
        out.append(sorted({v / 2 + values[bisect_right(values, v)] / 2 for v in below}))
    return out


def fit_on_cells(rows: DataFrame, features: Sequence[str], numbers: Sequence[str], label: str, kind: str) -> PipelineModel:
    """A pipeline over ``features`` fitted on cells of equal bins of ``numbers`` and equal other features.
    A cell is split at random while there are few, so that a tree's subsample stays one of rows."""
    spark = rows.sparkSession
    binned = [f"{c}_bin" for c in numbers]
    bucketizer = Bucketizer(inputCols=list(numbers), outputCols=binned, handleInvalid="skip",
                            splitsArray=[[-math.inf, *e, math.inf] if e else [-math.inf, 0.0, math.inf] for e in bin_edges(rows, numbers)])
    keys = [f"{c}_bin" if c in numbers else c for c in features]
    r = bucketizer.transform(rows).select(*keys, label)
    n = r.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
    r = r.withColumn("_part", F.floor(F.rand(42) * max(CELLS // max(n, 1), 1)))
    cells = r.groupBy(*keys, "_part").agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))
    cells = materialize(cells.repartition(spark.sparkContext.defaultParallelism))
    fitted = M.pipeline(keys, M.regressor(kind, label, weight="_rows")).fit(cells)
    return PipelineModel([bucketizer, *fitted.stages])


def fit_bundle(train: DataFrame, held: DataFrame, label: str, category: str, dummy: str, numbers: Sequence[str],
               kind: str = "gbt") -> tuple[PipelineModel, DataFrame, Facts]:
    """A pipeline fitted on the labelled rows of ``train``, and its mean absolute error on
    those of ``held`` (null without any). The dummy column's first level has no column."""
    train, held = (d.filter(F.col(label).isNotNull()) for d in (train, held))
    # one pass: sums per (category, level) give the levels and all means
    sums = materialize(train.groupBy(F.col(category).alias("category"), F.col(dummy).alias("level")).agg(F.sum(label).alias("s"), F.count(label).alias("n")))
    levels = sorted(r[0] for r in sums.select("level").distinct().collect() if r[0] is not None)[1:]
    means = sums.filter(F.col("category").isNotNull()).groupBy("category").agg((F.sum("s") / F.sum("n")).alias("_mean"))
    mean = sums.agg(F.try_divide(F.sum("s"), F.sum("n"))).first()[0]
    if mean is None:
        raise ValueError("no labelled rows to fit on")
    features = ["_category_mean", *[f"_{c}" for c in numbers], *[f"is_{v}" for v in levels]]
    facts = Facts(category, dummy, levels, list(numbers), features, mean, None)
    means = materialize(means)
    encoded = materialize(encode(train, means, facts).select(*features, label))
    n = encoded.count()
    if kind == "gbt" and n > CELLS:
        model = fit_on_cells(encoded, features, features[:1 + len(numbers)], label, kind)
    else:
        model = M.pipeline(features, M.regressor(kind, label, n_rows=max(n, 1))).fit(encoded)
    mae = model.transform(encode(held, means, facts)).agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0]
    return model, means, Facts(**{**asdict(facts), "mae": mae})


class Registry:
    """Bundles under ``root/name/version=n``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, text: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, name: str) -> list[int]:
        """Complete versions: their facts, written last, are there."""
        path, fs = self._path(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        found = [f.getPath().getName() for f in fs.listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in found if n.startswith("version=")
                      and fs.exists(self._path(f"{self.root}/{name}/{n}/facts/_SUCCESS")[0]))

    def save(self, name: str, bundle: tuple[PipelineModel, DataFrame, Facts]) -> int:
        version = (self.versions(name) or [0])[-1] + 1
        while True:  # an incomplete version keeps its number
            path, fs = self._path(f"{self.root}/{name}/version={version}")
            if not fs.exists(path):
                break
            version += 1
        at = f"{self.root}/{name}/version={version}"
        model, means, facts = bundle
        model.write().save(f"{at}/model")
        means.write.parquet(f"{at}/means")
        self.spark.createDataFrame([(json.dumps(asdict(facts)),)], "value string").write.text(f"{at}/facts")
        return version

    def load(self, name: str, version: int | None = None) -> tuple[PipelineModel, DataFrame, Facts]:
        have = self.versions(name)
        if not have or (version is not None and version not in have):
            raise ValueError(f"no complete version {version or ''} of {name}")
        at = f"{self.root}/{name}/version={version or have[-1]}"
        facts = Facts(**json.loads(self.spark.read.text(f"{at}/facts").first()[0]))
        return PipelineModel.load(f"{at}/model"), self.spark.read.parquet(f"{at}/means"), facts


def confidence(prediction: Column, mae: float | None) -> Column:
    """1 / (1 + mae / (abs(p) + 1e-9)); null where the bundle has no error, or none above 0."""
    return 1 / (1 + F.lit(mae) / (F.abs(prediction) + 1e-9)) if mae else F.lit(None).cast("double")


def score_requests(requests: DataFrame, registry: Registry, names: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """One row per request and horizon: (keys, horizon, prediction, confidence, label).
    ``names`` maps horizons to bundles; nothing is fitted here."""
    out = None
    for horizon, name in names.items():
        model, means, facts = registry.load(name)
        p = model.transform(encode(requests, means, facts))
        p = p.select(*keys, F.lit(horizon).alias("horizon"), "prediction", confidence(F.col("prediction"), facts.mae).alias("confidence"))
        out = p if out is None else out.unionByName(p)
    return out.withColumn("label", F.when(F.col("prediction") > 0, "gain").otherwise("loss"))
