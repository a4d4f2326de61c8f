"""Spark session defaults and lineage-cutting helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library assumes. AQE re-plans joins and
# coalesces partitions at runtime; skew-join splitting covers hot keys
# that reach a shuffle join; UTC keeps calendar functions identical to
# the DuckDB oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide feature tables (40+ derived columns under one null filter) make
    # constraint inference grow combinatorially at plan time.
    "spark.sql.constraintPropagation.enabled": "false",
}


def build_session(master: str | None = None, app: str = "quantspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.

    Only when a local session names none (tests) a scratch folder is created
    so that ``checkpoint()`` works at all; on a cluster that is an error, as
    executors don't share the driver's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="qs-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes to the shared checkpoint folder and cuts
    lineage, so a lost executor re-reads the files instead of recomputing
    the upstream scan. Used where one table feeds several jobs."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """``materialize`` as Parquet in the shared checkpoint folder: later jobs read only
    the columns they use and know the table's size. Removed when the driver's JVM ends.

    ``instead_of`` is an earlier result of ``write_once`` that only ``df`` still
    needed: its folder is removed as soon as ``df`` is written."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.parquet(path)
    for old in {f.rsplit("/", 1)[0] for f in (instead_of.inputFiles() if instead_of is not None else ())}:
        gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return spark.read.schema(df.schema).parquet(path)
