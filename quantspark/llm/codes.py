"""Vector codes from per-part codebooks, fitted by active-entry Lloyd rounds.

A vector, as integers, is cut into equal consecutive parts, and each part
position has a codebook of a fixed number of entries. A round assigns every part
to its nearest entry (squared Euclidean distance, ties to the lower index) and
moves every used entry to its parts' componentwise floor of the mean.

The first assignment compares every entry. Each part then keeps its entry and
its exact distance. In later assignments, where that entry did not move, the
other unmoved entries cannot have come nearer, so only the moved ones are
compared with the kept distance (a moved entry at the same distance wins only
with a lower index). Parts whose entry moved are compared with all entries
again. Results equal those of full scans.

Distances and codes are made in tasks, in blocks of rows; each task sends one
row per used entry with a count and sums, which Spark adds up as decimals. Only
the codebooks (parts x entries x part width) reach the driver and go back to the
tasks. Rounds are staged in the shared folder, so a lost executor repeats its
own blocks only. Sums are of integers, so reruns agree.

Defined cases: null vectors and those with null or non-finite components are
dropped; shorter vectors count as padded with zeros, also up to a multiple of
``parts`` (one component per part at least); the entries start from the smallest ids, each id once (of several
rows of one id the smallest vector), a null id last, and are fewer where there
are fewer ids; an empty table gives no rows; null labels are summed together;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.common import read, stage
from quantspark.llm.vectors import integer_vectors, matrix, products_exact_in_doubles

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 2048
HOT_SHARE = 64  # a label with a 64th of all rows is joined by broadcast; there are 64 such labels at most


def squared_distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per part and one column per entry."""
    most = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    kind = np.float64 if products_exact_in_doubles(2 * most, parts.shape[1]) else np.int64
    p, e = parts.astype(kind), entries.astype(kind)
    return ((p * p).sum(axis=1)[:, None] + (e * e).sum(axis=1)[None] - 2 * (p @ e.T)).astype(np.int64)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of each part's nearest entry, ties to the lower index."""
    d = squared_distances(parts, entries)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(at)), at]


def reassign(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entries after those of ``moved`` have moved, given each
    part's entry and distance before."""
    code, dist = code.copy(), dist.copy()
    lost = moved[code]
    if lost.any():
        code[lost], dist[lost] = nearest(parts[lost], entries)
    stays, active = np.flatnonzero(~lost), np.flatnonzero(moved)
    if len(stays) and len(active):
        at, d = nearest(parts[stays], entries[active])
        at = active[at]
        better = (d < dist[stays]) | ((d == dist[stays]) & (at < code[stays]))
        code[stays[better]], dist[stays[better]] = at[better], d[better]
    return code, dist


def _assign(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """(id, label, v, codes, dists); with ``moved``, from the codes and
    distances that ``rows`` has."""
    parts, _, part = books.shape

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                b = batch.slice(i, BLOCK)
                n = b.num_rows
                x = matrix(b.column(2), parts * part).reshape(n, parts, part)
                codes, dists = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
                if moved is not None:
                    codes = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint16).reshape(n, parts).astype(np.int64)
                    dists = np.frombuffer(b"".join(b.column(4).to_pylist()), np.int64).reshape(n, parts).copy()
                for s in range(parts):
                    if moved is None:
                        codes[:, s], dists[:, s] = nearest(x[:, s], books[s])
                    else:
                        codes[:, s], dists[:, s] = reassign(x[:, s], books[s], moved[s], codes[:, s], dists[:, s])
                yield pa.RecordBatch.from_arrays([
                    *b.columns[:3], pa.array([r.tobytes() for r in codes.astype(np.uint16)], pa.binary()),
                    pa.array([r.tobytes() for r in dists], pa.binary())], names=["id", "label", "v", "codes", "dists"])

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in ("id", "label", "v"))
    return rows.mapInArrow(run, f"{kinds}, codes binary, dists binary")


def _moved_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry at the floor of its parts' mean."""
    parts, entries, part = books.shape

    def run(batches):
        count = np.zeros(parts * entries, np.int64)
        total = np.zeros((part, parts * entries), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                b = batch.slice(i, BLOCK)
                x = matrix(b.column(0), parts * part).reshape(-1, part)
                codes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, parts).astype(np.int64)
                at = (codes + np.arange(parts) * entries).ravel()
                count += np.bincount(at, minlength=parts * entries)
                for c in range(part):  # a block's sums are exact in doubles
                    total[c] += np.bincount(at, weights=x[:, c], minlength=parts * entries).astype(np.int64)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(list(total[:, used].T), pa.list_(pa.int64()))],
                                         names=["at", "n", "sums"])

    sums = [F.sum(F.get("sums", c).cast("decimal(38,0)")).alias(f"s{c}") for c in range(part)]
    found = rows.select("v", "codes").mapInArrow(run, "at long, n long, sums array<long>").groupBy("at").agg(F.sum("n").alias("n"), *sums)
    out = books.copy()
    for row in found.collect():  # one row per used entry
        out[row.at // entries, row.at % entries] = [int(row[f"s{c}"]) // row.n for c in range(part)]
    return out


def _first_books(rows: DataFrame, parts: int, entries: int, part: int) -> np.ndarray:
    ids = rows.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries)
    first = (rows.join(F.broadcast(ids.withColumnRenamed("id", "first_id")), F.col("id").eqNullSafe(F.col("first_id")))
             .groupBy("id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("id")).collect())
    out = np.zeros((len(first), parts * part), np.int64)
    for i, row in enumerate(first):
        out[i, :len(row.v)] = row.v
    return np.ascontiguousarray(out.reshape(len(first), parts, part).transpose(1, 0, 2))


def compress(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes: one uint16 per part, dists: one int64 per part) and the
    final codebooks, an array of parts x entries x part width."""
    base = stage(integer_vectors(rows, vector, {"id": id_col, "label": label}, scale), "integers")
    width = base.agg(F.max(F.size("v"))).first()[0] or 0
    books = _first_books(base, parts, entries, max(1, -(-width // parts)))
    moved, state = None, base
    for _ in range(rounds):
        state = stage(_assign(state, books, moved), "codes")
        new = _moved_books(state, books)
        moved, books = (new != books).any(axis=2), new
    return stage(_assign(state, books, moved).drop("v"), "codes"), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_totals(rows: DataFrame, label: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows of the same label. Labels
    with a large share of the rows, of which there can only be a few, are joined
    by broadcast, the rest by a shuffle."""
    totals = stage(rows.groupBy(F.col(label).alias("_label")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("_n")), "totals")
    n = totals.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(totals.filter(F.col("_n") * HOT_SHARE >= n))
    same = F.col(label).eqNullSafe(F.col("_label"))
    common = rows.join(hot, same)
    rest = rows.join(hot, same, "left_anti").join(totals.filter(F.col("_n") * HOT_SHARE < n), same)
    return common.unionByName(rest).drop("_label", "_n")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    parts = books.shape[0]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(n, parts)
            error = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64).reshape(n, parts).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes().hex() for r in codes.astype(np.uint8)], pa.string()),
                                              pa.array(error)], names=["vec_id", "label", "code", "error"])

    kinds = dict(coded.dtypes)
    flat = stage(coded.mapInArrow(run, f"vec_id {kinds['id']}, label {kinds['label']}, code string, error long"), "errors")
    return (with_label_totals(flat, "label", "error", "label_error")
            .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB: full scans of every entry in every round."""
    def assign(k):
        return f"""a{k} AS (
        SELECT p.r, p.s, any_value(p.x) AS x, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + b.e) AS m
        FROM pieces p JOIN b{k} b USING (s) GROUP BY p.r, p.s)"""

    def update(k):
        return f"""b{k + 1} AS (
        SELECT b.s, b.e, coalesce(u.x, b.x) AS x FROM b{k} b LEFT JOIN (
            SELECT s, e, list(v ORDER BY c) AS x FROM (
                SELECT s, m % {entries} AS e, c, CAST(floor(sum(x[c])::DOUBLE / count(*)) AS BIGINT) AS v
                FROM a{k}, (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM pieces)::BIGINT)) AS c) GROUP BY 1, 2, 3) GROUP BY 1, 2) u USING (s, e))"""

    steps = [f"b0 AS (SELECT s, e, x FROM pieces JOIN first USING (r))", assign(0)]
    for k in range(rounds):
        steps += [update(k), assign(k + 1)]
    return f"""
        WITH ints AS (
        SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
        pieces AS (
        SELECT r, s, v[s * len(v) // {parts} + 1:(s + 1) * len(v) // {parts}] AS x FROM ints, (SELECT unnest(range({parts})) AS s)),
        first AS (SELECT r, r - 1 AS e FROM ints WHERE r <= {entries}),
        {", ".join(steps)},
        coded AS (
        SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY s) AS code, sum(m // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r),
        totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN ints USING (r) GROUP BY label),
        digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY s, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM coded JOIN ints USING (r) JOIN totals ON ints.label IS NOT DISTINCT FROM totals.label, digest"""


ORACLE = _oracle()
