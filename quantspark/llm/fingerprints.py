"""Document fingerprints by consistent weighted sampling.

A text's weighted terms are its shingles of ``WORDS`` words (runs outside ASCII
white space), each weighing as often as it occurs. For sample j and term k of
weight S, r and c ~ Gamma(2, 1) and b ~ Uniform(0, 1) are drawn from (j, k) alone:

    t = floor(ln S / r + b),   a = c * exp(-r * (t - b + 1))

and the sample is the (k, t) of least a. Two texts agree in a sample with a
probability equal to their generalised Jaccard similarity, sum of min over sum
of max of the weights. The draws come from the 64-bit hash of (j, k), however
many terms a text has. At weight 1, t = 0 and a is Exp(1), so the hash itself is
read as 1 - exp(-a) and its order is that of the draws. Given that a, c - a and
r - ln(c / a) are Exp(1) and b = 1 - ln(c / a) / r, which is how a heavier term
gets the r, c and b that belong to its draw at weight 1. A fingerprint is
``SAMPLES`` samples of 16 bits.

The edited text of a document needs its neighbour by id. Rows are dealt into
ranges of ids that begin at ids picked by hash (a bounded list), and the first
row of a range is copied to the end of the one before (of the first range to the
last). So each range is read in order by one task that holds two batches.

Defined cases: a null text is an empty one and has the fingerprint of no terms;
two texts without terms have likeness 1; a document alone in the table is its
own neighbour; rows without an id have no place in the order, an edited text
without borrowed end, and near_next null; rows of equal id stand in the order of
their texts' hashes; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.llm.common import byte_windows, read, text_buffer
from quantspark.llm.wordhash import mix, shingles, word_hashes

SAMPLES, WORDS = 64, 5
WINDOW_BYTES = 1 << 18
RANGES, RANGE_ROWS = 1 << 14, 64
_NAME = np.uint64(0xFFFF)
_SALTS = mix(np.arange(1, 4097, dtype=np.uint64))


def _draws(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The draw at weight 1, r, and the exponential part of r, of hashes of (sample, term)."""
    def exponential(x):
        return -np.log1p(-((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52)

    once, more = exponential(h), exponential(mix(h ^ np.uint64(0x9E3779B97F4A7C15)))
    rest = exponential(mix(h ^ np.uint64(0xD1B54A32D192ED03)))
    return once, np.log1p(more / once) + rest, rest


def _sample(terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """(len(starts), samples) of the terms between one start and the next."""
    heavy = np.flatnonzero(weights > 1)
    log_w = np.log(weights[heavy])
    out = np.empty((len(starts), samples), np.uint16)
    for j in range(samples):
        key = mix(terms ^ _SALTS[j])
        if len(heavy):
            h = key[heavy]
            once, r, rest = _draws(h)
            t = np.floor((log_w + rest) / r)
            least = (-np.expm1(-once * np.exp(-r * t)) * 2.0 ** 64).astype(np.uint64)
            name = h ^ (t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            # at t = 0 a term is drawn as at weight 1
            key[heavy] = np.where(t > 0, (least & ~_NAME) | (name & _NAME), h)
        out[:, j] = np.minimum.reduceat(key, starts) & _NAME
    return out


def signatures(data: np.ndarray, offsets: np.ndarray, samples: int = SAMPLES, words: int = WORDS) -> np.ndarray:
    """(rows, samples) for the UTF-8 texts that ``offsets`` cut out of ``data``."""
    out = np.full((len(offsets) - 1, samples), 0xFFFF, np.uint16)
    for i, j in byte_windows(offsets, WINDOW_BYTES):
        h, rows = shingles(*word_hashes(data, offsets[i:j + 1]), words)
        if not len(h):
            continue
        # rows < 4096: their number and 52 bits of the term sort as one integer
        key, counts = np.unique((rows.astype(np.uint64) << np.uint64(52)) | (h >> np.uint64(12)), return_counts=True)
        row = (key >> np.uint64(52)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[i + row[starts]] = _sample(mix(key & np.uint64((1 << 52) - 1)), counts, starts, samples)
    return out


def _hex(sig: np.ndarray) -> list[str]:
    width = sig.shape[1] * 4
    text = sig.astype(">u2").tobytes().hex()
    return [text[i:i + width] for i in range(0, len(text), width)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def fingerprint(docs: DataFrame, samples: int = SAMPLES, words: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint), one row per document."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            sig = signatures(*text_buffer(batch.column(1)), samples, words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_hex(sig), pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _dealt(docs: DataFrame) -> DataFrame:
    """(range, last, doc_id, text): rows by range, with the copied heads marked ``last``."""
    spark = docs.sparkSession
    ids = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
    n, least = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    step = max(RANGE_ROWS, -(-n // RANGES))
    picked = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).distinct().toArrow().column(0).to_numpy() if n else []
    heads = spark.sparkContext.broadcast(np.unique(np.r_[picked, [least]].astype(np.int64)) if n else np.zeros(0, np.int64))

    def run(batches):
        first = heads.value
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            value = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            spread = mix(np.arange(len(value), dtype=np.uint64)) % np.uint64(max(len(first), 1))
            home = np.where(known, np.searchsorted(first, value, "right") - 1, spread.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(np.where(known, 0, 2).astype(np.int32)), ids, batch.column(1)], names=names)
            if len(first):
                at = np.minimum(np.searchsorted(first, value), len(first) - 1)
                copied = np.flatnonzero(known & (first[at] == value))
                if len(copied):
                    take = pa.array(copied)
                    yield pa.RecordBatch.from_arrays([
                        pa.array((home[copied] - 1) % len(first)), pa.array(np.ones(len(copied), np.int32)),
                        ids.take(take), batch.column(1).take(take)], names=names)

    names = ["range", "last", "doc_id", "text"]
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(run, "range long, last int, doc_id long, text string")


def with_neighbours(docs: DataFrame, samples: int = SAMPLES, words: int = WORDS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): each document against its text with the last
    quarter replaced by the next document's beginning, and against the next."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def finish(home, last, ids, texts, more):
        """All rows but the last one, whose neighbour is not here yet (none is left out when ``more`` is False)."""
        n = len(texts) - (1 if more else 0)
        if n <= 0:
            return None
        own = signatures(*text_buffer(pa.array(texts, pa.string())), samples, words)
        follows = [i + 1 if i + 1 < len(texts) and home[i + 1] == home[i] and last[i + 1] < 2 and last[i] == 0 else -1 for i in range(n)]
        edited = []
        for i in range(n):
            q = len(texts[i]) // 4
            edited.append(texts[i][:len(texts[i]) - q] + (texts[follows[i]][:q] if follows[i] >= 0 else ""))
        keep = [i for i in range(n) if last[i] != 1]
        edits = signatures(*text_buffer(pa.array([edited[i] for i in keep], pa.string())), samples, words)
        mine = own[keep]
        after = np.array([follows[i] for i in keep], np.int64)
        near_next = likeness(mine, own[after])
        return pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in keep], pa.int64()), pa.array([len(texts[i]) for i in keep], pa.int64()),
            pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
            pa.array(_hex(mine), pa.string()), pa.array(_hex(edits), pa.string()), pa.array(likeness(mine, edits)),
            pa.array(near_next, mask=after < 0)], names=names)

    def run(batches):
        held = ([], [], [], [])
        for batch in batches:
            _, offs = text_buffer(batch.column(3))
            for i, j in byte_windows(offs, 8 * WINDOW_BYTES):
                part = batch.slice(i, j - i)
                held = tuple(a + part.column(c).to_pylist() for c, a in enumerate(held))
                done = finish(*held, True)
                if done is not None:
                    yield done
                held = tuple(a[-1:] for a in held)
        done = finish(*held, False)
        if done is not None:
            yield done

    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = _dealt(docs).repartitionByRange(parts, "range").sortWithinPartitions("range", "last", "doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(run, schema)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(read(spark, sf_dir, "documents"))
