"""Wide period tables over a many-to-many crosswalk.

``melt_periods`` turns a table with one column per period into rows (``unpivot``).
``crosswalk_medians`` carries values of large units over to the small units that
lie in them and takes medians there. A large unit with many rows and many small
units multiplies both, so its values are first counted, which bounds its rows by
its distinct values. Counts by bins of the values are carried over first and tell
which bin holds a small unit's median; only that bin's values are carried over
themselves, both sides split: the counted values into ``SPLIT_ROWS`` rows a piece,
the map copied to as many pieces. Medians are found by ranges of (unit, value),
never by one task per unit.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.operators.ranks import running_totals
from quantspark.session import write_once

PERIOD = re.compile(r"\d{4}-\d{2}-\d{2}\Z")
SPLIT_ROWS = 100_000
BINS = 1024


def period_columns(df: DataFrame) -> list[str]:
    """Columns named by a date, in order of time; the rest are ids."""
    return sorted(c for c in df.columns if PERIOD.match(c))


def melt_periods(df: DataFrame, ids: Sequence[str], value: str = "value", date: str = "date") -> DataFrame:
    """(ids, date, value): a row per id row and period; text that is no number is null."""
    long = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in period_columns(df)]).unpivot(list(ids), None, date, value)
    return long.select(*ids, F.to_date(date).alias(date), F.expr(f"try_cast(`{value}` AS double)").alias(value))


def crosswalk_medians(values: DataFrame, unit: str, by: Sequence[str], value: str, crosswalk: DataFrame, small: str,
                      split_rows: int = SPLIT_ROWS, bins: int = BINS) -> DataFrame:
    """(small, by, value): the median over all rows of all units that a small unit
    lies in; a unit listed twice for it counts twice, as in a plain join. Units
    without small units, and null units on either side, drop out; a group without any
    value has a null."""
    counted = write_once(values.filter(F.col(unit).isNotNull()).groupBy(unit, *by, value).agg(F.count(F.lit(1)).alias("_m")), "counted")
    cross = write_once(crosswalk.select(unit, small).filter(F.col(unit).isNotNull()).groupBy(unit, small).agg(F.count(F.lit(1)).alias("_c")), "crosswalk")
    # about equally filled bins of the values of each ``by``, equal values in one bin
    distinct = counted.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum("_m").alias("_m"))
    ranked = running_totals(distinct, by, [F.col(value)], {"_r": "_m"})
    ranked = ranked.select(F.struct(*by, value).alias("_key"), F.floor(F.col("_r_before") * bins / F.col("_r_all")).alias("_bin"))
    binned = write_once(counted.filter(F.col(value).isNotNull()).withColumn("_key", F.struct(*by, value)).join(ranked, "_key").drop("_key"), "binned")
    # the bins that hold a small unit's middle ranks, from counts by bin
    full = binned.groupBy(unit, *by, "_bin").agg(F.sum("_m").alias("_m"))
    full = full.join(cross, unit).groupBy(small, *by, "_bin").agg(F.sum(F.col("_m") * F.col("_c")).alias("_m"))
    t = running_totals(full, [small, *by], [F.col("_bin")], {"_n": "_m"})
    low, high = F.floor((F.col("_n_all") - 1) / 2), F.floor(F.col("_n_all") / 2)

    def here(rank):
        return (F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_m"))

    wanted = write_once(t.filter(here(low) | here(high)).select(small, *by, "_bin", F.col("_n_before").alias("_base"), low.alias("_low"), high.alias("_high")), "wanted")
    # only the values of those bins meet the small units; both sides are split
    key = F.struct(unit, *by, "_bin").alias("_key")
    asked = wanted.withColumn("_s", F.struct(small)).drop(small).join(cross.withColumn("_s", F.struct(small)), "_s").drop("_s")
    pieces = binned.groupBy(unit, *by, "_bin").agg(F.ceil(F.count(F.lit(1)) / split_rows).cast("int").alias("_pieces")).select(key, "_pieces")
    left = binned.select(key, value, "_m").join(pieces, "_key").withColumn("_piece", F.pmod(F.xxhash64(value), F.col("_pieces")))
    right = asked.select(key, small, *by, "_bin", "_base", "_low", "_high", "_c").join(pieces, "_key").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    met = left.select("_key", "_piece", value, "_m").join(right.drop("_pieces"), ["_key", "_piece"])
    rows = met.groupBy(small, *by, "_bin", "_base", "_low", "_high", value).agg(F.sum(F.col("_m") * F.col("_c")).alias("_m"))
    t = running_totals(rows, [small, *by, "_bin"], [F.col(value)], {"_n": "_m"}).withColumn("_n_before", F.col("_n_before") + F.col("_base"))
    medians = t.groupBy(small, *by).agg(((F.max(F.when(here(F.col("_low")), F.col(value))) + F.max(F.when(here(F.col("_high")), F.col(value)))) / 2).alias(value))
    every = counted.select(unit, *by).distinct().join(cross, unit).select(small, *by).distinct().withColumn("_key", F.struct(small, *by))
    return every.join(medians.select(F.struct(small, *by).alias("_key"), value), "_key", "left").drop("_key")
