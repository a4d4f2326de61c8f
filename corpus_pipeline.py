"""The training-data pipeline: documents through five operators, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.

* toxicity: documents that the classifier rejects go.
* simhash: of each group of near-duplicates the smallest doc_id stays.
* secrets: every secret that the scan finds is masked in the text.
* mixing: the training order of the mix; documents stand as often as the mix
  takes them, the copy that crosses a source's target cut to the words left.
* bpe: per document of the mix its ids' number and digest, and the digest of
  the bytes that decode from them.

Defined cases are those of the operators: null and empty texts, null and
repeated ids, empty tables and extra columns pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantspark.llm import bpe, mixing, secrets, simhash, toxicity
from quantspark.llm.common import read, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

# The classifier, SimHash's XXH64 and the tokenizer have no SQL form; tests hold
# the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + "-".join(name.split()))
    return docs
