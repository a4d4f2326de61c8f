"""Helpers shared by the operators: staged tables, fresh names, Arrow text access."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quantspark.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder, removed
    when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, later jobs
    re-read files instead of recomputing, and a lost executor costs nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(filesystem, path) of a folder that driver and tasks share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


@contextmanager
def scoped(spark: SparkSession, **settings: str):
    """Session settings (names after ``spark.sql.``, two underscores for a dot) for the
    actions within; the old values come back afterwards."""
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def with_fields(df: DataFrame, **fields: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(k, v, True) for k, v in fields.items())])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 byte offsets of its rows,
    without copying where there are no nulls. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offs


def byte_windows(offsets: np.ndarray, limit: int, rows: int = 4096):
    """Row ranges [i, j) holding at most ``limit`` bytes (one row at least) and ``rows`` rows."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n, i + rows)
        yield i, j
        i = j
