"""File sources and sinks.

Readers declare schemas (no inference pass over the data), read every part
file in parallel and clean rows with expressions, so junk rows, preambles
and header rows may sit anywhere in any part file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.functions.clean import yyyymmdd

TIME_CANDIDATES = ("timestamp", "Timestamp", "datetime", "time", "date", "Date", "window_start")
CLOSE_CANDIDATES = ("close", "Close", "price", "adj_close", "Adj Close")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return os.path.join(spark.conf.get("spark.checkpoint.dir"), "files", f"{name}-{uuid.uuid4().hex}")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> DataFrame:
    """S1 + S3: CSV read with an all-string declared schema."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", header).schema(schema).csv(path)


def drop_junk_rows(df: DataFrame, date_col: str, fmt: str | None = None) -> DataFrame:
    """Keep rows whose date column parses; header-like rows vanish."""
    parsed = F.try_to_timestamp(F.col(date_col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(date_col))
    return df.filter(parsed.isNotNull()).withColumn(date_col, F.to_date(parsed))


def read_factor_file(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Preamble lines and footers are skipped by parsing the first
    field as ``yyyyMMdd``; percent values become fractions."""
    raw = read_csv_strings(spark, path, columns, header=False)
    d = raw.withColumn("date", yyyymmdd(F.col(columns[0]))).filter(F.col("date").isNotNull())
    return d.select("date", *[(F.col(c).try_cast("double") / 100).alias(c) for c in columns[1:]])


def discover(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate name present in the header (driver-side, on the
    schema only)."""
    present = set(columns)
    for c in candidates:
        if c in present:
            return c
    return None


def parse_time(c: str | Column) -> Column:
    """S12 + P6: epoch seconds or timestamp text."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.timestamp_seconds(x.try_cast("bigint")), F.try_to_timestamp(x.cast("string")))


def write_partitioned_parquet(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Parquet partitioned by a key so that readers prune folders."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def discover_by_content(df: DataFrame, name_pattern: str, value_pattern: str) -> str | None:
    """First column whose name matches ``name_pattern`` (regex,
    case-insensitive) and whose first non-null value matches
    ``value_pattern``; each probe reads one value (``limit(1)``)."""
    import re
    for c in df.columns:
        if not re.search(name_pattern, c, re.IGNORECASE):
            continue
        row = df.select(F.col(c).cast("string")).filter(F.col(c).isNotNull()).limit(1).collect()
        if row and re.fullmatch(value_pattern, row[0][0] or ""):
            return c
    return None
