"""Connected components of an edge table by alternating large and small stars.

Every round is two joins against one-row-per-node minima and a ``distinct``,
staged in the shared folder. Rounds grow with the logarithm of the number of
nodes. Only counts and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    mark = F.bit_xor(F.xxhash64("u", "v"))  # edges are distinct; a sum would leave the range of a long
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(mark, F.lit(0))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, root): every node of an edge with the
    smallest node that it is connected to. No edges: no rows."""
    edges = stage(edges.filter("u <> v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        state, old = _state(edges), state
        if state == old:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
