"""As-of joins (J9-J12) as a sort-based union, not an inequality join.

Left and right rows are unioned per key, ordered by time with a side flag
that encodes strictness, and each left row takes the last (backward) or
first (forward) right payload with ``ignorenulls``. The payload is a struct,
so a right row whose cells are null still counts as present (row-presence
semantics of ``merge_asof``).

With ``bucket_width`` the time axis is cut into buckets: the window runs per
(key, bucket), and a left row with no match inside its bucket takes the
carry from the small per-(key, bucket) table of last/first right rows. A hot
key is then spread over all its buckets instead of one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_T, _SIDE, _R, _B, _TB = "_qs_t", "_qs_side", "_qs_r", "_qs_b", "_qs_tb"


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_on: str | Column,
              right_on: str | Column, values: Sequence[str], direction: str = "backward",
              inclusive: bool = True, right_tiebreak: str | Column | None = None,
              prefix: str = "", bucket_width: int | None = None,
              axis: str = "day") -> DataFrame:
    """Attach ``values`` of the matching right row to every left row.

    direction='backward': latest right row with time <= (or <) left time.
    direction='forward': earliest right row with time >= (or >) left time.
    ``axis`` tells how to bucket the time for ``bucket_width``: 'day'
    (DATE/TIMESTAMP -> day number) or 'number' (already integer).
    Adds ``{prefix}{v}`` columns and ``{prefix}matched`` (bool).
    """
    keys = list(keys)
    lt = F.col(left_on) if isinstance(left_on, str) else left_on
    rt = F.col(right_on) if isinstance(right_on, str) else right_on
    right_first_at_ties = (direction == "backward") == inclusive
    l_side, r_side = (1, 0) if right_first_at_ties else (0, 1)

    payload = F.struct(*[F.col(v).alias(v) for v in values], F.lit(True).alias("_present"))
    tb = right_tiebreak if right_tiebreak is not None else F.lit(0)
    tb = F.col(tb) if isinstance(tb, str) else tb
    r = right.select(*keys, rt.alias(_T), F.lit(r_side).alias(_SIDE), payload.alias(_R),
                     tb.cast("double").alias(_TB))
    l_cols = [c for c in left.columns]
    l = left.select(*l_cols, lt.alias(_T), F.lit(l_side).alias(_SIDE),
                    F.lit(None).cast(r.schema[_R].dataType).alias(_R), F.lit(0.0).alias(_TB))
    missing = [c for c in l_cols if c not in keys]
    r = r.select(*keys, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in missing],
                 _T, _SIDE, _R, _TB)
    u = l.select(*keys, *missing, _T, _SIDE, _R, _TB).unionByName(r)

    # Forward lookups run as backward ones over the reversed order: Spark
    # evaluates a [unbounded preceding, current] frame incrementally, while
    # a [current, unbounded following] frame is recomputed for every row.
    # Reversing every sort key keeps the tie rules (side flag, tiebreak).
    if direction == "backward":
        order = [F.col(_T), F.col(_SIDE), F.col(_TB)]
    else:
        order = [F.col(_T).desc(), F.col(_SIDE).desc(), F.col(_TB).desc()]
    pick = lambda w: F.last(_R, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    if bucket_width is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        u = u.withColumn("_qs_m", pick(w))
    else:
        num = (F.datediff(F.to_date(F.col(_T)), F.lit("1970-01-01").cast("date"))
               if axis == "day" else F.col(_T))
        u = u.withColumn(_B, F.floor(num / bucket_width))
        w = Window.partitionBy(*keys, _B).orderBy(*order)
        u = u.withColumn("_qs_m", pick(w))
        # per (key, bucket): the last (first) right payload; a bucket with no
        # right row takes the nearest earlier (later) one. The spine of all
        # buckets on either side is small: one row per (key, bucket).
        rights = u.filter(F.col(_SIDE) == r_side)
        if direction == "backward":
            edge = rights.groupBy(*keys, _B).agg(F.max_by(_R, F.struct(_T, _TB)).alias("_qs_e"))
            cw = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
            carry_of = lambda: F.last("_qs_e", ignorenulls=True).over(cw)
        else:
            edge = rights.groupBy(*keys, _B).agg(F.min_by(_R, F.struct(_T, _TB)).alias("_qs_e"))
            cw = Window.partitionBy(*keys).orderBy(F.col(_B).desc()).rowsBetween(Window.unboundedPreceding, -1)
            carry_of = lambda: F.last("_qs_e", ignorenulls=True).over(cw)
        # joined on one struct, never null itself, so that null keys match too
        k = "_qs_key"
        u = u.withColumn(k, F.struct(*[F.col(c) for c in (*keys, _B)]))
        edge = edge.select(F.struct(*[F.col(c) for c in (*keys, _B)]).alias(k), "_qs_e")
        spine = u.select(k).distinct().join(edge, k, "left").select(k, f"{k}.*", "_qs_e")
        carry = spine.select(k, carry_of().alias("_qs_c"))
        u = u.join(carry, k, "left").withColumn("_qs_m", F.coalesce("_qs_m", "_qs_c"))

    out = u.filter(F.col(_SIDE) == l_side)
    sel = [F.col(c) for c in l_cols]
    sel += [F.col(f"_qs_m.{v}").alias(f"{prefix}{v}") for v in values]
    sel.append(F.coalesce(F.col("_qs_m._present"), F.lit(False)).alias(f"{prefix}matched"))
    return out.select(*sel)
