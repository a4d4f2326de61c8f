"""One cross-section from ragged series (D6, W27): the last valid value per key
and column with its age, and first, previous and last values for slopes and growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_valid(df: DataFrame, key: str, date: str, cols: Sequence[str]) -> DataFrame:
    """(key, {c}, {c}_age): per key each column's last non-null value and its age in
    days at the last date of the whole table. One aggregate, no sort; a column without
    values is null with a null age."""
    as_of = df.agg(F.max(date)).first()[0]
    when = {c: F.when(F.col(c).isNotNull(), F.col(date)) for c in cols}
    return df.groupBy(key).agg(*[x for c in cols for x in (F.max_by(c, when[c]).alias(c),
                                                           F.datediff(F.lit(as_of), F.max(when[c])).alias(f"{c}_age"))])


def slope(col: str, date: str) -> Column:
    """Aggregate: (last - first) / first of the non-null values; null with fewer than two."""
    at = F.when(F.col(col).isNotNull(), F.col(date))
    first, last = F.min_by(col, at), F.max_by(col, at)
    return F.when(F.count(col) >= 2, F.try_divide(last - first, first))


def with_previous_valid(df: DataFrame, key: str, date: str, cols: Sequence[str]) -> DataFrame:
    """``{c}_prev``: the last non-null value before the row. Series are bounded by the
    calendar (a row per key and period)."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"{c}_prev") for c in cols])


def growth(col: str, date: str) -> Column:
    """Aggregate over rows with ``{col}_prev``: (last - previous) / previous of the
    non-null values; null with fewer than two or a previous value of 0."""
    at = F.when(F.col(col).isNotNull(), F.col(date))
    last, prev = F.max_by(col, at), F.max_by(f"{col}_prev", at)
    return F.try_divide(last - prev, F.nullif(prev, F.lit(0.0)))
