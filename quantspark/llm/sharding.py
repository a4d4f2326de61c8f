"""Sharding by a permutation-filled lookup table, in DataFrame operations only.

Every shard has a preference order over the slots of a table of prime size,
(offset + i * skip) mod size, from two hashes of its name. Shards take turns;
each claims the first slot of its order that is free, until the table is full.
Slots per shard differ by one at most, and when a shard is added or removed few
slots change hands besides those that have to. The table is made on the driver
once per shard list (its size is a parameter, not data) and sent to all tasks
as a broadcast of that many rows; a document's shard is one look-up at
hash(id) mod size.

Defined cases: a row without an id is placed by its remaining light columns
(source, lang, n_chars, where there); repeated ids go to one shard; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.common import read

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard's index in ``shards`` at every slot."""
    if not _is_prime(size):
        raise ValueError("the table's size must be prime, so that every skip visits all slots")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    at = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards]
    # turns go by name, so that the order of the list doesn't matter
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    table, free = [-1] * size, size
    while free:
        for s in turns[:free]:
            while table[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % size
            table[at[s]] = s
            free -= 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """First 60 bits of the key's MD5, modulo the table's size."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long") % size


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) of the filled table."""
    text = ",".join(map(str, lookup_table(shards, size)))
    names = F.split(F.lit("\n".join(shards)), "\n")
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "at"))
    return slots.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("at").cast("int")).alias("shard"))


def place(docs: DataFrame, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, slot, shard), one row per row of ``docs``."""
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "n_chars") if c in docs.columns]
    key = F.coalesce(F.col(id_col).cast("string"), F.concat_ws("|", F.lit("no id"), *rest))
    keyed = docs.select(F.col(id_col).alias("doc_id"), slot_of(key, size).alias("slot"))
    return keyed.join(F.broadcast(table_frame(docs.sparkSession, shards, size)), "slot").select("doc_id", "slot", "shard")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(read(spark, sf_dir, "documents"))


def oracle(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> str:
    """DuckDB: the same look-up in the same table."""
    text = ",".join(map(str, lookup_table(shards, size)))
    key = ("coalesce(doc_id::VARCHAR, concat_ws('|', 'no id', coalesce(source, ''), coalesce(lang, ''), coalesce(n_chars::VARCHAR, '')))")
    names = "[" + ", ".join(f"'{s}'" for s in shards) + "]"
    return f"""
        WITH filled AS (SELECT string_split('{text}', ',') AS t),
        keyed AS (SELECT doc_id, ('0x' || substr(md5({key}), 1, 15))::BIGINT % {size} AS slot FROM documents)
        SELECT doc_id, slot, ({names})[(t[slot + 1])::INT + 1] AS shard FROM keyed, filled"""
