"""SimHash near-duplicates, with candidates from Golay-code fuzzy hashing.

Fingerprint: words are runs outside ASCII white space, A-Z lower-cased;
shingles of ``words`` words (a shorter text is one shingle, an empty or null
one has fingerprint 0), XXH64 (seed 42) of each, repeats included; a bit is set
where more than half of the hashes have it.

Candidates at two or fewer differing bits: the 64 bits are cut into three
segments (22, 21, 21 bits, zero-padded to the 23 bits of the perfect binary
Golay code). With at most two errors some segment is exact while the segment
after it has at most one error. So a key is (segment, its exact value, index of
a codeword near the next segment). A segment within distance 2 of its codeword
gets that one index; at distance 3 it also gets the five codewords at distance
4, after which two segments one bit apart always share an index. Fingerprints
are joined on keys and verified by their differing bits.

A key with more than ``group_limit`` fingerprints is not joined pairwise. All
its fingerprints go to an exact star step instead: each emits itself and its 64
one-bit neighbours, all that meet at one of these are within two bits of each
other, and are linked to the smallest one. Both steps together lose no link
between components and emit rows in proportion to the fingerprints.

Defined cases: equal texts share a fingerprint; rows with a null id get a
fingerprint and the smallest non-null id of their component (null if it has
none); repeated rows are kept; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.llm.common import fresh, read, stage, text_buffer, with_fields
from quantspark.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
GROUP_LIMIT = 16
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, chunk: int = 1 << 16) -> int:
    import xxhash
    tokens = text.lower().split()
    if not tokens:
        return 0
    grams = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if len(tokens) >= words else iter([b" ".join(tokens)])
    total = max(len(tokens) - words + 1, 1)
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), grams)
    ones = np.zeros(64, np.int64)
    for done in range(0, total, chunk):
        h = np.fromiter(hashed, dtype=np.uint64, count=min(chunk, total - done))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def add_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", words: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long."""
    schema, at = with_fields(docs, **{name: T.LongType()}), docs.columns.index(text)

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(at))
            view = memoryview(data)
            fp = np.array([fingerprint(bytes(view[a:b]), words) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())],
                          dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def _syndromes(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where(x >> bit & 1, GOLAY << (bit - 11), 0)
    return x


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error of weight 3 or less, and the five of weight 4
    (-1 where the first has weight under 3)."""
    near, far = np.zeros(2048, np.int64), np.full((2048, 5), -1, np.int64)
    for weight in (1, 2, 3):
        e = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)])
        near[_syndromes(e)] = e
    e = np.array([sum(1 << b for b in c) for c in combinations(range(23), 4)])
    s = _syndromes(e)
    order = np.argsort(s, kind="stable")
    far[np.unique(s)] = e[order].reshape(-1, 5)
    return near, far


def golay_indices(x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(n, 6) codeword indices near each 23-bit word; -1 where there are fewer."""
    near, far = tables
    s = _syndromes(x)
    more = far[s]
    return np.concatenate([((x ^ near[s]) >> 11)[:, None], np.where(more >= 0, (x[:, None] ^ more) >> 11, -1)], axis=1)


def fuzzy_keys(fp: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in ``fp``) of every key of every fingerprint."""
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    keys, rows = [], []
    for i in range(3):
        idx = golay_indices(seg[(i + 1) % 3], tables)
        row, col = np.nonzero(idx >= 0)
        keys.append((i << 34) | (seg[i][row] << 12) | idx[row, col])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches):
        tables = golay_tables()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(fp):
                key, row = fuzzy_keys(fp, tables)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` that give the same
    components as all pairs at two or fewer differing bits."""
    keyed = stage(_keyed(fps), "keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = stage(keyed.join(sizes, "key"), "live-keys")
    small = live.filter(F.col("n") <= group_limit)
    pairs = (small.select("key", F.col("fp").alias("u")).join(small.select("key", F.col("fp").alias("v")), "key")
             .filter((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS))
             .select("u", "v"))
    crowded = live.filter(F.col("n") > group_limit).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), b) for b in range(64)])
    around = stage(crowded.select("fp", F.explode(flips).alias("flip"))
                   .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")), "around")
    meet = around.groupBy("z").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("z", "v")
    stars = around.join(meet, "z").select(F.col("fp").alias("u"), "v").filter("u <> v")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id), one row per document."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    fps = stage(add_fingerprints(base, words=words).select("doc_id", "fp"), "fingerprints")
    return fps.join(classes(fps, group_limit).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def classes(fps: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """From (doc_id, fp): (fp, component_id, keep_fp). ``keep_fp`` is the
    fingerprint of the component's smallest document (the smallest fingerprint
    where no document has an id)."""
    own = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    comp = connected_components(links(own.select("fp"), group_limit))
    own = own.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    top = own.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("no"), "least", "fp")).alias("top"))
    return own.join(top, "root").select("fp", F.col("top.least").alias("component_id"), F.col("top.fp").alias("keep_fp"))


def deduplicate(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Documents, one of each group: the one with the smallest id (of repeated
    rows with that id and fingerprint, one). Only ids, fingerprints and digests
    of the texts are staged, and ``docs`` is read again for the rows they name:
    it must give the same rows both times, as a table does."""
    cols, digest = docs.columns, F.sha2(F.coalesce("text", F.lit("")), 256)
    ids = stage(add_fingerprints(docs.select("doc_id", "text", digest.alias("digest")), words=words)
                .select("doc_id", "fp", "digest"), "fingerprints")
    keep = (classes(ids).filter(F.col("fp") == F.col("keep_fp"))
            .select(F.col("fp").alias("__fp"), F.col("component_id").alias("__id")))
    kept = (ids.join(keep, (F.col("fp") == F.col("__fp")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            .groupBy("doc_id", "fp").agg(F.min("digest").alias("digest")))
    # as one struct, ids may be null; rows that stand twice are folded first, and the join needs no other shuffle of the texts
    row = fresh(docs, "row")
    single = docs.withColumn(row, F.struct("doc_id", digest.alias("digest"))).dropDuplicates([row])
    name = fresh(single, "row")
    wanted = kept.select(F.struct("doc_id", "digest").alias(name))
    return single.join(wanted, F.col(row) == F.col(name), "left_semi").select(*cols)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
