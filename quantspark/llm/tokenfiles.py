"""Token counts of the documents in flat, unindexed token files.

A token file is nothing but ids of fixed width, little-endian; an end-of-document
id closes each document. ``scan`` cuts the files into blocks of ``BLOCK_TOKENS``
ids. A task reads its block's bytes, finds the separators with one vectorised
comparison, and keeps a row per block: its tokens, the first and last separator,
and the lengths of the documents that lie within. Documents that cross blocks
are stitched by a prefix scan over these rows: a block's first separator closes
a document that began after the last separator of any block before, and its
documents are numbered from the separators before. No task reads a whole file,
and what is scanned in order is one small row per block.

``write_files`` makes such files from documents with a public byte-level BPE
vocabulary, one per partition, with a manifest (file, position, doc_id). A file
is written under its attempt's name and then moved, so that a repeated or
speculative task leaves one whole file. Files are reached through
``pyarrow.fs`` (local and mounted paths, HDFS, object stores).

Defined cases: null and empty texts are documents of no tokens; ids may be null
or repeated; a file may be empty, hold separators only, or end without one (its
rest is a document with ``closed`` false); a size that isn't a whole number of
ids is an error; an empty table gives no files or empty ones, and no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.llm.bpe import load_ranks, vocabulary_path
from quantspark.llm.common import open_fs, read, shared_path, stage

END_OF_DOCUMENT = 50_256
WIDTH = 2
BLOCK_TOKENS = 1 << 21
CHUNK_ROWS = 256


def write_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END_OF_DOCUMENT, width: int = WIDTH) -> DataFrame:
    """Write token files into ``folder`` and return the staged manifest (file, position, doc_id)."""
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("position", T.LongType()), docs.schema["doc_id"]])
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path or vocabulary_path()))  # one vocabulary

    def run(batches):
        import public_tokenizers
        import tiktoken
        from pyspark import TaskContext
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}.bin"
        files, root = open_fs(folder)
        files.create_dir(root, recursive=True)
        draft, done = f"{root}/_{name}.{task.taskAttemptId()}", 0
        with files.open_output_stream(draft) as out:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK_ROWS):
                    part = batch.slice(at, CHUNK_ROWS)
                    for text in part.column(1).to_pylist():
                        ids = np.asarray(encoding.encode_ordinary(text or ""), dtype=np.int64)
                        out.write(np.append(ids, end).astype(f"<u{width}").tobytes())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * part.num_rows), pa.array(np.arange(done, done + part.num_rows)), part.column(0)], names=schema.names)
                    done += part.num_rows
        files.move(draft, f"{root}/{name}")

    return stage(docs.select("doc_id", "text").mapInArrow(run, schema), "manifest")


def list_files(folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of the token files of a folder."""
    from pyarrow import fs
    files, root = open_fs(folder)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def scan(spark: SparkSession, folder: str, names: Sequence[tuple[str, int]] | None = None, end: int = END_OF_DOCUMENT,
         width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, position, start, n_tokens, closed): every document of the folder's files."""
    names = list_files(folder) if names is None else list(names)
    odd = [n for n, size in names if size % width]
    if odd:
        raise ValueError(f"not a whole number of {width}-byte ids: {odd[:5]}")
    listed = spark.createDataFrame(names, "file string, bytes long").withColumn("tokens", (F.col("bytes") / width).cast("long")).filter("tokens > 0")
    blocks = listed.select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block_tokens))).alias("block"))
    n = sum(max(1, -(-size // (width * block_tokens))) for _, size in names)

    def run(batches):
        files, root = open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["block"] * block_tokens
                many = min(block_tokens, row["tokens"] - start)
                with files.open_input_file(f"{root}/{row['file']}") as f:
                    ids = np.frombuffer(f.read_at(many * width, start * width), f"<u{width}")
                at = np.flatnonzero(ids == end)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["file"]]), pa.array([start]), pa.array([many]),
                    pa.array([int(at[0]) if len(at) else None], pa.int64()), pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                    pa.array([(np.diff(at) - 1).astype(np.int32)], pa.list_(pa.int32()))],
                    names=["file", "start", "tokens", "first", "last", "inner"])

    # one block per task, or a few
    each = blocks.repartition(max(1, min(n, 4096)), "file", "block").mapInArrow(
        run, "file string, start long, tokens long, first long, last long, inner array<int>")
    rows = stage(each, "blocks")
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.size("inner")
    closed = F.when(F.col("first").isNull(), F.lit(0)).otherwise(inner + 1)
    scanned = rows.select(
        "file", "start", "tokens", "first", "last", "inner",
        F.coalesce(F.sum(closed.cast("long")).over(so_far), F.lit(0)).alias("before"),
        (F.coalesce(F.max(F.col("start") + F.col("last")).over(so_far), F.lit(-1)) + 1).alias("began"),
        F.lead("start").over(Window.partitionBy("file").orderBy("start")).isNull().alias("final"))
    head = scanned.filter(F.col("first").isNotNull()).select(
        "file", F.col("before").alias("position"), F.col("began").alias("start"),
        (F.col("start") + F.col("first") - F.col("began")).alias("n_tokens"), F.lit(True).alias("closed"))
    # within a block: the n-th inner document starts after the first separator and those before it
    rest = scanned.filter(inner > 0).select("file", "before", (F.col("start") + F.col("first") + 1).alias("base"), "inner")
    listed_inner = rest.select("file", "before", "base", F.posexplode("inner").alias("i", "n"))
    upto = Window.partitionBy("file", "base").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    middle = listed_inner.select(
        "file", (F.col("before") + 1 + F.col("i")).alias("position"),
        (F.col("base") + F.coalesce(F.sum((F.col("n") + 1).cast("long")).over(upto), F.lit(0))).alias("start"),
        F.col("n").cast("long").alias("n_tokens"), F.lit(True).alias("closed"))
    end_at = F.col("start") + F.col("tokens")
    opened = F.coalesce(F.col("start") + F.col("last") + 1, F.col("began"))
    tail = scanned.filter(F.col("final") & (opened < end_at)).select(
        "file", (F.col("before") + closed).alias("position"), opened.alias("start"), (end_at - opened).alias("n_tokens"), F.lit(False).alias("closed"))
    return head.unionByName(middle).unionByName(tail)


def count_tokens(docs: DataFrame, folder: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, file, position, start, n_tokens) of documents written to token files and scanned."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    manifest = write_files(docs, folder)
    return scan(spark, folder, block_tokens=block_tokens).join(manifest, ["file", "position"]).select(
        "doc_id", "file", "position", "start", "n_tokens")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
