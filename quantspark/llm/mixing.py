"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) have weights 5, 2, 1, repeating,
and share all words by weight; a target stops at ``cap`` times its source's size
and the excess is shared again by weight, until none is above. That is one level
``x`` with target = min(cap * size, x * weight), found by a few aggregates over
the table of sources.

Curriculum: each source has a schedule, a piecewise linear density over training
time 0 to 1. Its integral, times the target, is the source's cumulative demand.
A source's documents stand in hash order of their ids; a document that starts
after ``c`` words is trained on where the cumulative demand is ``c``, so its
position is the inverse of the integral at c / target (a quadratic in each
piece). A source with a target above its size goes round again, up to ``cap``
times; the copy that crosses the target is cut to the words that are left. The
mix is range-sorted by position.

Running sums don't put a source in one task: rows are numbered in buckets of
the hash, whose totals (about the root of the largest source's rows) are summed
per source, and bucket by bucket within.

Defined cases: a null or empty text has size 0, is never taken, and has no
position; a null source is a source of its own; ids may be null or repeated
(repeated rows count as often as they stand there); an empty table or one
without words gives targets of 0; extra columns are ignored by ``assign`` and
kept by ``mix``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.llm.common import fresh, read, stage

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"
# By weight class: (time, density) knots. Heavy sources lead, light ones follow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (source, size): staged (source, sid, weight, source_size, n, target).
    One row per source; only sums over them reach the driver."""
    spark = sized.sparkSession
    # the window runs over one row per source
    order = Window.orderBy(F.col("source").isNull(), "source")
    totals = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
              .withColumn("sid", F.row_number().over(order) - 1))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    sources = stage(totals.withColumn("weight", F.get(kinds, F.pmod("sid", F.lit(len(weights))))), "sources")
    limit = F.col("source_size") * cap
    total, weight = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).first()
    level, old = total / weight, -1.0
    while level != old:
        full = limit <= F.lit(level) * F.col("weight")
        fixed, open_weight = sources.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        level, old = ((total - fixed) / open_weight if open_weight else level), level
    return stage(sources.withColumn("target", F.least(limit.cast("double"), F.lit(float(level)) * F.col("weight"))), "targets")


def _pieces(schedules) -> Column:
    """Per class: the pieces of its integral (from, start of the piece, density there, slope), scaled to 1 at the end."""
    classes = []
    for knots in schedules:
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        done, rows = 0.0, []
        for (t0, m0), (t1, m1) in zip(knots, knots[1:]):
            rows.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in (
                ("done", done), ("t0", t0), ("density", m0 / area), ("slope", (m1 - m0) / (t1 - t0) / area))]))
            done += (t1 - t0) * (m0 + m1) / 2 / area
        classes.append(F.array(*rows))
    return F.array(*classes)


def training_time(share: Column, sid: Column, schedules=SCHEDULES) -> Column:
    """Where the integral of the source's schedule reaches ``share`` (0 to 1)."""
    mine = F.get(_pieces(schedules), F.pmod(sid, F.lit(len(schedules))))
    at = F.element_at(F.filter(mine, lambda p: p["done"] <= share), -1)
    more = share - at["done"]
    root = F.sqrt(F.greatest(at["density"] * at["density"] + 2 * at["slope"] * more, F.lit(0.0)))
    return F.least(at["t0"] + F.when(at["density"] + root > 0, 2 * more / (at["density"] + root)).otherwise(0.0), F.lit(1.0))


def _assign(rows: DataFrame, weights, cap: int, schedules) -> DataFrame:
    """From staged (.., key, source, size): with source_size, target and copies
    (array of copy, words, position)."""
    targets = source_targets(rows.select("source", "size"), weights, cap)
    most = targets.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    digits = max(1, math.ceil(math.log(most / max(512, math.sqrt(most)), 16)))
    keyed = (rows.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("bucket", F.substring("key", 1, digits)))
    ahead = Window.partitionBy("sid").orderBy("bucket")
    offsets = (keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
               .withColumn("before", F.sum("words").over(ahead) - F.col("words")).drop("words"))
    inside = Window.partitionBy("sid", "bucket").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (keyed.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["sid", "bucket"])
              .withColumn("start", F.col("before") + F.col("upto") - F.col("size")))
    goal = F.floor(F.col("target") + 0.5).cast("long")

    def copy(r):
        at = F.col("start") + r * F.col("source_size")
        words = F.greatest(F.least(goal - at, F.col("size")), F.lit(0).cast("long"))
        share = F.least(F.coalesce(F.try_divide(at.cast("double"), F.col("target")), F.lit(0.0)), F.lit(1.0))
        return F.struct(r.cast("int").alias("copy"), words.alias("words"), training_time(share, F.col("sid"), schedules).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(cap - 1).cast("long")), copy), lambda c: c["words"] > 0)
    return placed.withColumn("copies", copies).drop("bucket", "before", "upto", "start", "sid", "weight", "n")


def assign(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, schedules=SCHEDULES) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per document."""
    rows = stage(docs.select("doc_id", "source", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
                             word_count("text").alias("size"), F.xxhash64("text").alias("tie")), "sizes")
    return _assign(rows, weights, cap, schedules).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, schedules=SCHEDULES) -> DataFrame:
    """The training order: ``docs`` range-sorted by position, each as often as
    the mix takes it, a cut copy with the text's first words (``n_chars``, where
    there is one, in step)."""
    row, got = fresh(docs, "row"), fresh(docs, "copy")
    marked = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rows = stage(marked.select(F.col(row).alias("id"), "source", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
                               word_count("text").alias("size"), F.xxhash64("text").alias("tie")), "sizes")
    each = (_assign(rows, weights, cap, schedules).select("id", "size", F.explode("copies").alias("c"))
            .select(F.col("id").alias("__id"), F.struct("size", "c.words", "c.position", "c.copy").alias(got)))
    taken = marked.join(each, F.col(row) == F.col("__id"))
    # a cut copy: its first words, each with the white space before it
    listed = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    first = F.array_join(F.slice(listed, F.lit(1), F.col(got)["words"].cast("int")), "")
    whole = F.col(got)["words"] == F.col(got)["size"]
    taken = taken.withColumn("text", F.when(whole, F.col("text")).otherwise(first))
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return taken.orderBy(F.col(got)["position"], F.col(got)["copy"], "doc_id").select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(read(spark, sf_dir, "documents"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return (out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.get("copies", F.lit(0))["position"].alias("position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))
