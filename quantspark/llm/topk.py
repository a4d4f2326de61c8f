"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are turned to integers (floor of 256 times each component) and sorted by
length into buckets of at most ``BUCKET`` rows. Queries are packed into blocks
and each block meets each bucket once (blocks are copied to groups of buckets and
joined on the group, so a vector's row is moved once and a query's once per
group). A first pass over the bucket of the longest vectors, which is broadcast
(one bucket, a fixed number of rows), gives every query a lower bound of its k-th
score. With it, in each bucket a query needs a cosine of at least

    bound / (query's length * bucket's longest length)

Above 1 the bucket is skipped; a block that skips a bucket with all its queries
doesn't reach Python. Otherwise the bucket picks one of two prunings: by length
(a prefix of the bucket, which is sorted), or, where the needed cosine is
``COORD_FROM`` or more, by coordinates: a candidate of cosine t or more with the
query has, in the query's largest coordinates f, q_f t -+ sqrt((1 - t^2)(1 -
q_f^2)). Survivors' products are computed exactly and the best k of each query
and bucket are merged. Bounds are widened by ``SLACK`` against rounding, and a
score equal to the bound is never pruned, so results are exact, ties included.

Defined cases: null vectors and those with null or non-finite components take
no part, nor do rows without an id; shorter vectors count as padded with zeros;
rows of one id are not each other's candidates, and as queries they count once
per distinct vector; an empty table gives no rows; extra columns are ignored.
Integers must keep their products under 2^63; beyond 2^20 per component products
are computed in 64-bit integers instead of doubles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.llm.common import read, stage

K, SCALE, BUCKET, QUERY_BLOCK, GROUP = 5, 256, 1024, 1024, 32
COORD_FROM, COORDS, SLACK = 0.6, 4, 1e-9
PACKED = "part long, longest double, n int, width int, ids binary, vectors binary"


def integers(rows: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v: array<long>, norm) of the rows that take part."""
    v = F.col(vector)
    fine = v.isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    kept = rows.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), ints.alias("v"))
    return kept.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """(part, longest, n, width, ids, vectors): runs of ``size`` rows of each
    partition, as binary matrices."""
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId() << 32
        held: list = []

        def packed():
            width = max([len(v) for _, v, _ in held], default=0)
            m = np.zeros((len(held), width), np.int64)
            for r, (_, v, _) in enumerate(held):
                m[r, :len(v)] = v
            ids = np.array([i for i, _, _ in held], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([part]), pa.array([max(x for _, _, x in held)]), pa.array([len(held)], pa.int32()),
                pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                names=[f.split()[0] for f in PACKED.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(3))):
                held.append(row)
                if len(held) == size:
                    yield packed()
                    part, held = part + 1, []
        if held:
            yield packed()

    return rows.mapInArrow(run, PACKED)


def _unpack(n, width, ids, vectors) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(n, width)


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, w - x.shape[1]))) if x.shape[1] < w else x for x in (a, b))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    most = max(np.abs(q).max(initial=0), np.abs(p).max(initial=0))
    if most < 1 << 20:  # sums of exact products stay under 2^53 for any usual width
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def best_of(q_ids, q, p_ids, p, bound, k: int):
    """(query row, id, score) of the k best of each query among the candidates
    that can reach its bound; ``p`` is sorted by falling length."""
    q, p = _same_width(q, p)
    ql = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    pl = np.sqrt((p.astype(np.float64) ** 2).sum(axis=1))
    longest = pl.max(initial=0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where((ql * longest > 0) & np.isfinite(bound), bound / (ql * longest), np.where(bound > 0, np.where(np.isfinite(bound), 2.0, -1.0), -1.0))
    need = np.where(np.isneginf(bound), -1.0, need)
    live = need <= 1 + SLACK
    rows, ids, scores = [], [], []

    def keep(r, cand_ids, s):
        ok = (cand_ids != q_ids[r]) & (s >= bound[r])
        cand_ids, s = cand_ids[ok], s[ok]
        if len(s) > k:
            cut = np.partition(s, len(s) - k)[len(s) - k]
            near = s >= cut
            cand_ids, s = cand_ids[near], s[near]
            order = np.lexsort((cand_ids, -s))[:k]
            cand_ids, s = cand_ids[order], s[order]
        rows.append(np.full(len(s), r)), ids.append(cand_ids), scores.append(s)

    by_coord = live & (need >= COORD_FROM)
    unit = None
    for r in np.flatnonzero(by_coord):
        if unit is None:
            unit = p / np.maximum(pl, 1e-300)[:, None]
        t, qu = min(need[r], 1.0), q[r] / ql[r]
        on = np.ones(len(p), bool)
        for f in np.argsort(-np.abs(qu))[:COORDS]:
            spread = np.sqrt(max((1 - t * t) * (1 - qu[f] ** 2), 0.0)) + 1e-6
            on &= (unit[:, f] >= qu[f] * t - spread) if qu[f] >= 0 else (unit[:, f] <= qu[f] * t + spread)
        c = np.flatnonzero(on)
        if len(c):
            keep(r, p_ids[c], _products(q[r:r + 1], p[c])[0])
    by_length = np.flatnonzero(live & ~by_coord)
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where((bound[by_length] > 0) & (ql[by_length] > 0), bound[by_length] / ql[by_length], -1.0)
        upto = np.searchsorted(-pl, -least * (1 - SLACK) + 1e-9, "right")
        s = _products(q[by_length], p[:upto.max()])
        for x, r in enumerate(by_length):
            keep(r, p_ids[:upto[x]], s[x, :upto[x]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)


def top_k(rows: DataFrame, queries, id_col: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score); ``queries`` is a condition on the id column."""
    spark = rows.sparkSession
    all_rows = stage(integers(rows, id_col, vector, scale), "integers")
    n = all_rows.count()
    parts = max(1, -(-n // (BUCKET * 4)))
    by_norm = all_rows.repartitionByRange(parts, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    buckets = stage(_pack(by_norm.select("id", "v", "norm"), BUCKET), "buckets")
    asked = all_rows.withColumnRenamed("id", id_col).filter(queries).withColumnRenamed(id_col, "id").dropDuplicates(["id", "v"])
    # queries of like length share a block
    q_parts = max(1, -(-asked.count() // (QUERY_BLOCK * 4)))
    blocks = stage(_pack(asked.repartitionByRange(q_parts, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
                         .select("id", "v", "norm"), QUERY_BLOCK), "queries")
    first = buckets.orderBy(F.desc("longest"), "part").limit(1).toArrow().to_pylist()
    head = spark.sparkContext.broadcast(first)  # one bucket

    def seed(batches):
        for batch in batches:
            for b in batch.to_pylist():
                q_ids, q = _unpack(b["n"], b["width"], b["ids"], b["vectors"])
                bound = np.full(len(q_ids), -np.inf)
                for h in head.value:
                    r, _, s = best_of(q_ids, q, *_unpack(h["n"], h["width"], h["ids"], h["vectors"]), bound, k)
                    for i in range(len(q_ids)):
                        mine = s[r == i]
                        if len(mine) == k:
                            bound[i] = mine.min()
                length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where((length > 0) & (bound > 0), bound / length, np.where(bound > 0, np.inf, -np.inf))
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["n"]], pa.int32()), pa.array([b["width"]], pa.int32()), pa.array([b["ids"]], pa.binary()),
                    pa.array([b["vectors"]], pa.binary()), pa.array([bound.tobytes()], pa.binary()), pa.array([float(reach.min())])],
                    names=["qn", "qwidth", "qids", "qvectors", "bounds", "reach"])

    seeded = stage(blocks.mapInArrow(seed, "qn int, qwidth int, qids binary, qvectors binary, bounds binary, reach double"), "seeded")
    groups = max(1, -(-buckets.count() // GROUP))
    grouped = buckets.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)))
    met = (grouped.join(seeded.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))), "group")
           .filter(F.col("longest") * (1 + SLACK) + SLACK >= F.col("reach")))

    def search(batches):
        for batch in batches:
            for b in batch.to_pylist():
                q_ids, q = _unpack(b["qn"], b["qwidth"], b["qids"], b["qvectors"])
                p_ids, p = _unpack(b["n"], b["width"], b["ids"], b["vectors"])
                r, ids, s = best_of(q_ids, q, p_ids, p, np.frombuffer(b["bounds"]), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r]), pa.array(ids), pa.array(s)], names=["query_id", "vec_id", "score"])

    found = met.select("n", "width", "ids", "vectors", "qn", "qwidth", "qids", "qvectors", "bounds").mapInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
    WITH ints AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
          AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM ints q, ints c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
