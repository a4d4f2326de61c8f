"""Integer vectors: the rows that take part, and their matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 24


def integer_vectors(rows: DataFrame, vector: str, keep: dict[str, str], scale: int = 256) -> DataFrame:
    """The columns ``keep`` (name -> column of ``rows``) and ``v``, floor(scale * x)
    of every component, of the rows whose vector is not null and holds neither
    nulls nor non-finite values. A component of ``LIMIT`` or more as an integer
    raises an error, as sums of squares would leave the range of a long."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    large = F.exists(v, lambda x: F.abs(x.cast("double")) * float(scale) >= float(LIMIT))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("int"))
    checked = F.when(large, F.raise_error(F.lit(f"a component times {scale} is {LIMIT} or more")).cast("array<int>")).otherwise(ints)
    return (rows.filter(v.isNotNull() & ~F.coalesce(odd, F.lit(True)))
            .select(*[F.col(c).alias(name) for name, c in keep.items()], checked.alias("v")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """int64 rows of a list column, shorter ones padded with zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(sizes) or (sizes == width).all():
        return flat.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def products_exact_in_doubles(most: int, terms: int) -> bool:
    """Whether sums of ``terms`` products of integers up to ``most`` stay under 2^53."""
    return most * most * max(terms, 1) < 1 << 53
