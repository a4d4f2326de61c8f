"""Helpers shared by the registered queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rnd(c: str | Column, digits: int = 6) -> Column:
    """Rounding that both engines evaluate bit-identically (IEEE multiply,
    add, floor) instead of each engine's own decimal rounding."""
    x = F.col(c) if isinstance(c, str) else c
    scale = 10 ** digits
    return F.floor(x * scale + 0.5) / scale


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(rnd(f.name, overrides.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            # ISO text: DATE values travel to pandas differently per engine
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_rnd(expr: str, digits: int = 6) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}"


def sql_round_select(inner: str, plain: Sequence[str], doubles: Sequence[str],
                     digits: int = 6, overrides: dict[str, int] | None = None,
                     dates: Sequence[str] = ()) -> str:
    overrides = overrides or {}
    parts = [f"strftime({c}, '%Y-%m-%d') AS {c}" if c in dates else c for c in plain]
    parts += [f"{sql_rnd(c, overrides.get(c, digits))} AS {c}" for c in doubles]
    return f"SELECT {', '.join(parts)} FROM ({inner}) q"


def sql_roll(agg: str, col: str, n: int, part: str, order: str) -> str:
    """Guarded rolling aggregate: NULL unless n non-null rows in the frame."""
    frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {frame} = {n} THEN {agg}({col}) {frame} END"


def names(cols: Iterable[str]) -> list[str]:
    return list(cols)
