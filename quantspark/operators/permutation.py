"""Permutation importance (M13): columns shuffled over all rows, repeats as a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.operators.ranks import rank_rows
from quantspark.session import materialize

REPEATS = 20


def shuffled(df: DataFrame, cols: Sequence[str], order: Sequence[Column], repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """Every row once per ``repeat``, with ``_perm_{c}``: the column's value in another
    row, by a seeded permutation of all rows that differs from repeat to repeat.

    Rows are numbered by ``order``, which must tell them apart, and take the row
    at the rank of their hash. Both numberings are spread over ranges, so no
    task sorts a whole repeat, and row and partner meet by equal numbers."""
    rows = materialize(rank_rows(df, [], order, "_row", "_rows").drop("_rows"))
    each = rows.select("_row", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat"))
    each = each.withColumn("_draw", F.xxhash64("_row", "repeat", F.lit(seed)))
    drawn = rank_rows(each, ["repeat"], [F.col("_draw"), F.col("_row")], "_at", "_rows")
    partner = rows.select(F.col("_row").alias("_at"), *[F.col(c).alias(f"_perm_{c}") for c in cols])
    return drawn.select("_row", "repeat", "_at").join(partner, "_at").join(rows, "_row").drop("_at", "_row")


def permutation_importance(model: Transformer, df: DataFrame, features: Sequence[str], label: str, order: Sequence[Column],
                           repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """(feature, repeats, rmse, importance, importance_std): by how much the error of
    ``model`` grows, over the repeats, when the feature is shuffled; one scoring
    pass over (row, repeat, feature). Rows without a label or a feature are left out;
    an empty table has no rows of importance."""
    df = df.select(*features, label, *[c.alias(f"_order{i}") for i, c in enumerate(order)]).dropna(subset=[*features, label])
    order = [F.col(f"_order{i}") for i in range(len(order))]
    base = model.transform(df).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), 2)))).first()[0]
    s = shuffled(df, features, order, repeats, seed)
    s = s.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    s = s.select("repeat", "feature", label, *[F.when(F.col("feature") == f, F.col(f"_perm_{f}")).otherwise(F.col(f)).alias(f) for f in features])
    errors = model.transform(s).groupBy("feature", "repeat").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), 2))).alias("rmse"))
    return errors.groupBy("feature").agg(
        F.count(F.lit(1)).cast("int").alias("repeats"), F.avg("rmse").alias("rmse"),
        F.avg(F.col("rmse") - F.lit(base)).alias("importance"), F.stddev_pop("rmse").alias("importance_std"))
