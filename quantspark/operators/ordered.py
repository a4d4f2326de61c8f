"""Series windows that stay balanced when one series is huge.

A window partitioned only by the series key sends a whole series to one
task; when one asset, owner or ticker holds a third of all rows that task
is the job. Three building blocks avoid it:

* ``number_rows``: a dense 1-based position per series, computed as
  (rows in earlier buckets) + row_number within (series, bucket). Only the
  small per-bucket count table is windowed per series.
* ``ordered_select``: bounded ROWS frames. Rows are cut into chunks of
  ``chunk_rows`` positions; the last ``back`` rows of each chunk are copied
  into the next chunk and the first ``fwd`` rows into the previous one, the
  window runs per (series, chunk) and the copies are dropped afterwards.
* ``prefix_select``: unbounded frames (running sums, counts, forward and
  backward fill). In-chunk windows plus a carry computed on the per-chunk
  summary table.

``range_select`` does the same for trailing RANGE frames over an integer
time axis (day numbers), copying only the rows that fall inside the frame
reach of the next bucket.

With ``chunk_rows=None`` each function falls back to the plain per-series
window; use that only where the series length is bounded by the calendar
(hourly bars over a fixed span), not by data volume.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quantspark.session import write_once

ROW = "_qs_rn"
CHUNK = "_qs_chunk"
HOME = "_qs_home"
CUT = "_qs_cut"

Level = Callable[[WindowSpec], Sequence[Column]]


def day_number(ts: str | Column) -> Column:
    """Days since 1970-01-01 for a DATE, TIMESTAMP or TIMESTAMP_NTZ column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
             how: str = "inner") -> DataFrame:
    # Plain equi-join on the names: both sides are already hash-partitioned
    # on these keys by the preceding window/aggregate, so the big side is
    # not shuffled again. Callers join on one struct of the series keys, which
    # is itself never null, so rows with null keys find their match.
    return left.join(right, list(keys), how)


def _key(*parts: str) -> Column:
    return F.struct(*[F.col(p) for p in parts])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                bucket: Column) -> DataFrame:
    """Adds ``_qs_rn``: 1-based position in (keys) ordered by ``order``.

    ``bucket`` must be non-decreasing along ``order`` (a day or hour number
    of the order timestamp). The order must be unique within a series so
    that numbering is deterministic.
    """
    b = "_qs_bucket"
    d = df.withColumn(b, bucket)
    k = "_qs_key"
    d = d.withColumn(k, _key(*keys, b))
    counts = d.groupBy(k).agg(F.count(F.lit(1)).alias("_qs_n"))
    carry = Window.partitionBy(*[F.col(f"{k}.{c}") for c in keys]).orderBy(f"{k}.{b}")
    offsets = counts.select(k, (F.sum("_qs_n").over(carry) - F.col("_qs_n")).alias("_qs_off"))
    d = d.withColumn(ROW, F.row_number().over(Window.partitionBy(k).orderBy(*order)))
    d = _join_on(d, offsets, [k])
    return d.withColumn(ROW, F.col(ROW) + F.col("_qs_off")).drop("_qs_off", b, k)


def cut_long_series(df: DataFrame, keys: Sequence[str], pos: str, chunk_rows: int) -> DataFrame:
    """Adds ``_qs_cut``, a bucket for ``number_rows``: 0 in series of up to ``chunk_rows``
    rows, in longer ones the chunk of ``pos``, a position among all rows. So no
    (series, cut) is longer than a chunk, and short series are not cut at all.
    The long ones are few: rows / ``chunk_rows`` at most."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_qs_n")).filter(F.col("_qs_n") > chunk_rows)
    long = write_once(sizes.drop("_qs_n").withColumn("_qs_long", F.lit(True)), "long-series")
    d = _join_few(df, long, keys, ["_qs_long"])
    return d.withColumn(CUT, F.when(F.col("_qs_long"), F.floor((F.col(pos) - 1) / chunk_rows)).otherwise(0)).drop("_qs_long")


def _join_few(df: DataFrame, few: DataFrame, keys: Sequence[str], out: Sequence[str]) -> DataFrame:
    """Left join of a small table to every row where it lies; null keys match null keys."""
    right = few.select(*[F.col(k).alias(f"_qs_r_{k}") for k in keys], *out)
    on = [F.col(k).eqNullSafe(F.col(f"_qs_r_{k}")) for k in keys]
    return df.join(F.broadcast(right), on or None, "left").drop(*[f"_qs_r_{k}" for k in keys])


def _with_halo(d: DataFrame, back: int, fwd: int, chunk_rows: int) -> DataFrame:
    if chunk_rows < max(back, fwd, 1):
        raise ValueError("chunk_rows must cover the frame reach")
    pos = (F.col(ROW) - 1) % chunk_rows
    home = F.floor((F.col(ROW) - 1) / chunk_rows)
    targets = F.array(home,
                      F.when(pos >= chunk_rows - back, home + 1),
                      F.when(pos < fwd, home - 1))
    return (d.withColumn(HOME, home)
             .withColumn(CHUNK, F.explode(F.filter(targets, lambda x: x.isNotNull()))))


def ordered_select(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   levels: Sequence[Level], back: int = 0, fwd: int = 0,
                   chunk_rows: int | None = None, bucket: Column | None = None, numbered: bool = False,
                   keep: bool = False) -> DataFrame:
    """Apply window levels with bounded ROWS frames.

    Each level gets a WindowSpec (partitioned by series, ordered by
    position) and returns aliased columns; later levels may use columns of
    earlier ones. ``back``/``fwd`` is the total reach of all levels in rows.
    ``numbered`` tells that ``df`` already has the positions of ``number_rows``
    for these keys and this order. With ``keep`` positions and chunks stay in the
    result, and a ``prefix_select`` over the same series works on the rows where
    they lie, without another shuffle.
    """
    if chunk_rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        out = df
        for level in levels:
            out = out.select("*", *level(w))
        return out
    if bucket is None and not numbered:
        raise ValueError("chunked windows need a bucket column")
    d = _with_halo(df if numbered else number_rows(df, keys, order, bucket), back, fwd, chunk_rows)
    w = Window.partitionBy(*keys, CHUNK).orderBy(ROW)
    for level in levels:
        d = d.select("*", *level(w))
    return d.filter(F.col(CHUNK) == F.col(HOME)).drop(HOME, *([] if keep else [ROW, CHUNK]))


def range_select(df: DataFrame, keys: Sequence[str], axis: str, levels: Sequence[Level],
                 reach: int, bucket_width: int | None = None) -> DataFrame:
    """Apply window levels with trailing RANGE frames over integer ``axis``.

    Frames may look back at most ``reach`` units. With ``bucket_width``
    (>= reach) the axis is cut into buckets and rows within ``reach`` of
    the next bucket are copied into it.
    """
    if bucket_width is None:
        w = Window.partitionBy(*keys).orderBy(axis)
        out = df
        for level in levels:
            out = out.select("*", *level(w))
        return out
    if bucket_width < reach:
        raise ValueError("bucket_width must cover the frame reach")
    home = F.floor(F.col(axis) / bucket_width)
    nxt = F.when(F.col(axis) >= (home + 1) * bucket_width - reach, home + 1)
    d = (df.withColumn(HOME, home)
           .withColumn(CHUNK, F.explode(F.filter(F.array(home, nxt), lambda x: x.isNotNull()))))
    w = Window.partitionBy(*keys, CHUNK).orderBy(axis)
    for level in levels:
        d = d.select("*", *level(w))
    return d.filter(F.col(CHUNK) == F.col(HOME)).drop(CHUNK, HOME)


# --- unbounded frames -------------------------------------------------------

def prefix_select(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  specs: Sequence[tuple[str, str, str]], chunk_rows: int | None = None,
                  bucket: Column | None = None, numbered: bool = False) -> DataFrame:
    """Running aggregates over unbounded frames.

    ``specs`` are (kind, input column, output column) with kind one of
    ``sum`` / ``count`` (rows up to and including the current one),
    ``sum_prior`` / ``count_prior`` (strictly earlier rows),
    ``ffill`` (last non-null up to the current row) and
    ``bfill`` (first non-null from the current row on). With ``numbered``
    ``df`` already has the positions of ``number_rows``; they stay in the result.
    Where it also has the chunks that ``ordered_select`` kept, these are used.
    """
    if chunk_rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        rev = Window.partitionBy(*keys).orderBy(*_reversed(order))
        return df.select("*", *[_direct(kind, c, w, rev).alias(out) for kind, c, out in specs])
    if bucket is None and not numbered:
        raise ValueError("chunked prefixes need a bucket column")
    d = df if numbered else number_rows(df, keys, order, bucket)
    if not (numbered and CHUNK in df.columns):
        d = d.withColumn(CHUNK, F.floor((F.col(ROW) - 1) / chunk_rows))
    rows = d
    w = Window.partitionBy(*keys, CHUNK).orderBy(ROW)
    rev = Window.partitionBy(*keys, CHUNK).orderBy(F.col(ROW).desc())
    local = [_direct(kind, c, w, rev).alias(f"_qs_l_{out}") for kind, c, out in specs]
    d = d.select("*", *local)

    # one row per (series, chunk): totals, then carried across chunks
    aggs = []
    for kind, c, out in specs:
        if kind in ("sum", "sum_prior"):
            aggs.append(F.sum(c).alias(f"_qs_t_{out}"))
        elif kind in ("count", "count_prior"):
            aggs.append(F.count(c).alias(f"_qs_t_{out}"))
        elif kind == "ffill":
            aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ROW))).alias(f"_qs_t_{out}"))
        elif kind == "bfill":
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ROW))).alias(f"_qs_t_{out}"))
        else:
            raise ValueError(kind)
    if numbered:
        # a series of one chunk carries nothing
        long = rows.filter(F.col(ROW) == chunk_rows + 1).select(*[F.col(c).alias(f"_qs_r_{c}") for c in keys], F.lit(True).alias("_qs_long"))
        rows = rows.join(F.broadcast(long), [F.col(c).eqNullSafe(F.col(f"_qs_r_{c}")) for c in keys] or None, "left_semi")
    summary = rows.groupBy(*keys, CHUNK).agg(*aggs)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for kind, c, out in specs:
        t = F.col(f"_qs_t_{out}")
        if kind in ("sum", "sum_prior", "count", "count_prior"):
            carried.append(F.sum(t).over(before).alias(f"_qs_c_{out}"))
        elif kind == "ffill":
            carried.append(F.last(t, ignorenulls=True).over(before).alias(f"_qs_c_{out}"))
        else:
            carried.append(F.last(t, ignorenulls=True).over(after).alias(f"_qs_c_{out}"))
    # the chunks besides a series' first and last are full, so few carry anything
    summary = summary.select(*keys, CHUNK, *carried).dropna("all", subset=[f"_qs_c_{out}" for _, _, out in specs])
    d = _join_few(d, summary, [*keys, CHUNK], [f"_qs_c_{out}" for _, _, out in specs])

    final = []
    for kind, c, out in specs:
        lo, ca = F.col(f"_qs_l_{out}"), F.col(f"_qs_c_{out}")
        if kind in ("sum", "sum_prior"):
            final.append(F.when(lo.isNull() & ca.isNull(), None)
                          .otherwise(F.coalesce(lo, F.lit(0)) + F.coalesce(ca, F.lit(0))).alias(out))
        elif kind in ("count", "count_prior"):
            final.append((lo + F.coalesce(ca, F.lit(0))).alias(out))
        else:
            final.append(F.coalesce(lo, ca).alias(out))
    keep = [c for c in df.columns]
    return d.select(*keep, *final)


def _reversed(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).desc() if isinstance(o, str) else o.desc() for o in order]


def _direct(kind: str, c: str, w: WindowSpec, rev: WindowSpec) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "sum":
        return F.sum(c).over(upto)
    if kind == "sum_prior":
        return F.sum(c).over(prior)
    if kind == "count":
        return F.count(c).over(upto)
    if kind == "count_prior":
        return F.count(c).over(prior)
    if kind == "ffill":
        return F.last(c, ignorenulls=True).over(upto)
    if kind == "bfill":
        # first non-null from here on = last non-null over the reversed order
        # (incremental frame instead of one recomputed per row)
        return F.last(c, ignorenulls=True).over(rev.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    raise ValueError(kind)


# --- guarded rolling expressions ------------------------------------------

def rolling(agg: Callable[[Column], Column], c: str | Column, w: WindowSpec, n: int,
            guard: bool = True) -> Column:
    """``agg`` over the last ``n`` rows; null unless all ``n`` are non-null
    (pandas ``rolling(n)`` with the default ``min_periods``)."""
    col = F.col(c) if isinstance(c, str) else c
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    value = agg(col).over(frame)
    if not guard:
        return value
    return F.when(F.count(col).over(frame) == n, value)


def forward(agg: Callable[[Column], Column], c: str | Column, w: WindowSpec, n: int) -> Column:
    """``agg`` over the next ``n`` rows (current row excluded), partial at
    the tail, nulls skipped."""
    col = F.col(c) if isinstance(c, str) else c
    return agg(col).over(w.rowsBetween(1, n))
