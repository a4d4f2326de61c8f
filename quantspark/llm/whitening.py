"""Whitening of vectors by exactly found principal components.

1. Components of the vectors become integers x; the fit list holds each distinct
   x vector once.
2. Tasks sum the fit list's counts, totals S and products; Spark adds them up as
   decimals. n * (sum of products) - S S' is an integer matrix, n^2 times the
   covariance.
3. Its characteristic polynomial is found modulo primes, a Spark row per prime,
   and joined by Chinese remaindering; the largest roots are enclosed by exact
   counts and each root's vector comes from inverse iteration (``polynomials``).
4. Every row's n * x - S is projected on the components and divided by the root
   of the eigenvalue. The whitened fit list's covariance is then measured.

Driver and tasks hold the matrix, whose size is the vectors' width squared, never
the vectors. Roots of the polynomial take the width cubed steps of long integers,
so widths of some hundreds are fine and thousands are slow.

Defined cases: null vectors and those with null or non-finite components are
dropped; shorter vectors count as padded with zeros; ids may be null or
repeated; where an eigenvalue is zero (fewer distinct vectors than components)
``whitened`` is null and takes no part in ``identity_error``, which is null where
no eigenvalue is positive; vectors narrower than the number of components have a
component per dimension; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.common import read, stage
from quantspark.llm.polynomials import ROOT_BITS, characteristic_polynomial, eigenvectors, largest_roots, square_root
from quantspark.llm.vectors import integer_vectors, matrix, products_exact_in_doubles

COMPONENTS, SCALE = 4, 256
BLOCK = 2048


def _products(x: np.ndarray) -> np.ndarray:
    if products_exact_in_doubles(int(np.abs(x).max(initial=0)), len(x)):
        x = x.astype(np.float64)
    return (x.T @ x).astype(np.int64)


def scatter(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, n * sum of products - S S') of the vectors ``v``, exact. Row 0 of the
    summed matrix and its column 0 stand for a component of 1 in every vector."""
    def run(batches):
        total = np.zeros((width + 1, width + 1), object)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                x = matrix(batch.column(0).slice(i, BLOCK), width)
                total += _products(np.c_[np.ones(len(x), np.int64), x])
        rows = [pa.array([[Decimal(int(y)) for y in total[r, r:]]], pa.list_(pa.decimal128(38, 0))) for r in range(width + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.concat_arrays(rows)], names=["r", "sums"])

    parts = fit.select("v").mapInArrow(run, "r int, sums array<decimal(38,0)>")
    cells = parts.select("r", F.posexplode("sums").alias("c", "x")).groupBy("r", "c").agg(F.sum("x").cast("decimal(38,0)").alias("x"))
    full = [[0] * (width + 1) for _ in range(width + 1)]
    for row in cells.collect():  # the matrix's cells
        full[row.r][row.r + row.c] = full[row.r + row.c][row.r] = int(row.x)
    n, s = full[0][0], full[0][1:]
    return n, s, [[n * full[i + 1][j + 1] - s[i] * s[j] for j in range(width)] for i in range(width)]


class Whitening:
    """Components of a fit list: n, S, the scatter's largest roots and their unit vectors."""

    def __init__(self, spark: SparkSession, n: int, s: list[int], m: list[list[int]], components: int):
        self.n, self.s, self.width = n, s, len(s)
        self.trace = sum(m[i][i] for i in range(self.width))
        how_many = min(components, self.width)
        if self.trace:
            self.roots = largest_roots(characteristic_polynomial(spark, m), how_many, self.trace)
        else:
            self.roots = [0] * how_many
        self.vectors = eigenvectors(m, self.roots)
        self.deviations = np.array([square_root(r) for r in self.roots])  # n times those of x
        # the enclosing interval of a root of nothing is (-1, 0]
        self.explained = [(r / 2.0 ** ROOT_BITS) / self.trace if self.trace else None for r in self.roots]

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in longs where they can hold it."""
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.s), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.s, kind)[None]

    def whitened(self, off: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.deviations > 0, off.astype(np.float64) @ self.vectors.T / self.deviations, np.nan)

    @staticmethod
    def squares(off: np.ndarray) -> list[Decimal]:
        most = int(np.abs(off).max(initial=0))
        if off.dtype != object and most * most * max(off.shape[1], 1) >= 1 << 63:
            off = off.astype(object)
        return [Decimal(int(y)) for y in (off * off).sum(axis=1)]


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the
    identity; means first, then centred products."""
    on = np.flatnonzero(w.deviations > 0)
    if not len(on):
        return None

    def sums(means):
        def run(batches):
            total = np.zeros((len(on), len(on))) if means is not None else np.zeros((len(on), 1))
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK):
                    y = w.whitened(w.offsets(matrix(batch.column(0).slice(i, BLOCK), w.width)))[:, on]
                    total += y.sum(axis=0)[:, None] if means is None else (y - means).T @ (y - means)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = fit.select("v").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("c", "x"))
        by = {r.c: r.x for r in parts.groupBy("c").agg(F.sum("x").alias("x")).collect()}
        return np.array([by[i] for i in range(len(by))]) / w.n

    covariance = sums(sums(None)).reshape(len(on), len(on))
    return float(np.abs(covariance - np.eye(len(on))).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation: decimal, whitened, explained, identity_error),
    a row per remaining row and component."""
    spark = rows.sparkSession
    kept = stage(integer_vectors(rows, vector, {"id": id_col}, scale), "integers")
    schema = (f"id {dict(kept.dtypes)['id']}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    width = kept.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:  # no rows, or none with a component
        return spark.createDataFrame([], schema)
    # equal vectors padded to the same width
    padded = F.when(F.size("v") == width, F.col("v")).otherwise(F.concat("v", F.array_repeat(F.lit(0), F.lit(width) - F.size("v"))))
    fit = stage(kept.select(padded.alias("v")).distinct(), "fit-list")
    w = Whitening(spark, *scatter(fit, width), components)
    error, n_components = identity_error(fit, w), len(w.roots)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                b = batch.slice(i, BLOCK)
                off = w.offsets(matrix(b.column(1), width))
                y, n = w.whitened(off), b.num_rows
                each = pa.array(np.repeat(np.arange(n), n_components))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(each), pa.array(np.tile(np.arange(1, n_components + 1, dtype=np.int32), n)), pa.array(np.full(n * n_components, w.n)),
                    pa.array(w.squares(off), pa.decimal128(38, 0)).take(each), pa.array(y.ravel(), mask=np.isnan(y.ravel())),
                    pa.array(w.explained * n, pa.float64()), pa.array([error] * (n * n_components), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long (tens of millions of distinct vectors) is null here; ``whiten`` has it as a decimal."""
    out = whiten(read(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
                      "whitened", "explained", "identity_error")
