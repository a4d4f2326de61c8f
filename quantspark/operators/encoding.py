"""Target statistics of category columns.

``ordered_target_means`` gives every row the mean label of the earlier rows
of its category, so that no row sees its own label; ``target_means`` gives new
rows the whole training mean. Both shrink towards the training mean by
``weight`` rows. Categories of any size are spread over tasks by ranges of
(column, category, order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.operators.ranks import running_totals

UNKNOWN = "Unknown"


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("category")) for c in cols]))
    return df.select(*keep, each.alias("_e")).select(*keep, "_e.column", "_e.category")


def _shrunk(total: Column, count: Column, prior: Column, weight: float) -> Column:
    return F.try_divide(total + prior * weight, count + F.lit(weight))


def _wide(long: DataFrame, row: Sequence[str], cols: Sequence[str], suffix: str) -> DataFrame:
    return long.groupBy(*row).agg(*[F.max(F.when(F.col("column") == c, F.col("_te"))).alias(c + suffix) for c in cols])


def ordered_target_means(df: DataFrame, row: str, cols: Sequence[str], label: str, order: Sequence[str], weight: float = 1.0,
                         suffix: str = "_te") -> DataFrame:
    """(row, {column}_te): for every category column the shrunk mean of ``label``
    over the rows of the same category that stand earlier in ``order`` (ties by
    ``row``, which must be unique). Rows without a label count as no earlier row
    but are encoded; a null category is one of its own."""
    prior = df.agg(F.avg(label)).first()[0]
    long = _long(df, cols, [row, *order, label]).withColumn("_y", F.coalesce(F.col(label).cast("double"), F.lit(0.0))).withColumn(
        "_m", F.col(label).isNotNull().cast("long"))
    t = running_totals(long, ["column", "category"], [*[F.col(c) for c in order], F.col(row)], {"_y": "_y", "_m": "_m"})
    t = t.withColumn("_prior", F.lit(prior).cast("double"))
    return _wide(t.withColumn("_te", _shrunk(F.col("_y_before"), F.col("_m_before"), F.col("_prior"), weight)), [row], cols, suffix)


def target_means(train: DataFrame, rows: DataFrame, row: str, cols: Sequence[str], label: str, weight: float = 0.0,
                 suffix: str = "_te") -> DataFrame:
    """(row, {column}_te): the shrunk mean of ``label`` over all training rows of the
    category; a category without training labels has the whole mean."""
    prior = F.lit(train.agg(F.avg(label)).first()[0]).cast("double")
    known = (_long(train.filter(F.col(label).isNotNull()), cols, [label]).groupBy("column", "category")
             .agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")))
    long = _long(rows, cols, [row]).join(known, ["column", "category"], "left")
    return _wide(long.withColumn("_te", F.coalesce(_shrunk(F.col("_s"), F.col("_n"), prior, weight), prior)), [row], cols, suffix)
