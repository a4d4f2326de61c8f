"""T1 registered query: streaming bars over the events files, with the bars
whose window is still open at the end of input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantspark.session import ensure_checkpoint_dir
from quantspark.streaming.bars import run_available_now


def q_t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return run_available_now(spark, sf_dir)


QUERIES = {"t1": q_t1}
ORACLE: dict[str, str] = {}
