"""Sharding by a permutation-filled lookup table: shards claim slots in turn, each by an order of preference of its own.

Adding or removing a shard moves little more than that shard's rows. Placement is one broadcast lookup, all in DataFrame functions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production parameters: shards, and a prime number of slots of at least a hundred times as many.
SHARDS, SLOTS = 32, 3203


def _number(text: str) -> int:
    """The first 60 bits of an MD5 digest."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int) -> list[int]:
    """The table: for each slot the index of the shard that claimed it.

    Shard i prefers slots offset, offset + skip, offset + 2 skip, ... modulo the prime ``slots``, a permutation of all of them.
    """
    if not shards or slots < len(shards) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("needs at least one shard and a prime number of slots, no fewer than shards")
    at = [_number(f"{s}/offset") % slots for s in shards]
    skip = [_number(f"{s}/skip") % (slots - 1) + 1 for s in shards]
    table, claimed = [-1] * slots, 0
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            claimed += 1
            if claimed == slots:
                return table


def slot(key: Column, slots: int) -> Column:
    """The slot of a key: the first 60 bits of its text's MD5 digest, modulo the table's size; a null key counts as empty text."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digest, 16, 10).cast("long") % slots).cast("int")


def lookup(spark: SparkSession, table: list[int]) -> DataFrame:
    """The table as slot and shard: as many rows as slots, whatever the data."""
    text = ",".join(map(str, table))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ","))).select(F.col("pos").alias("slot"), F.col("col").cast("int").alias("shard"))


def place(rows: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``rows`` with slot and shard. Every row gets one; equal keys share theirs; columns named slot or shard are replaced."""
    names = shards or [f"shard-{i}" for i in range(SHARDS)]
    kept = rows.drop("slot", "shard").withColumn("slot", slot(F.col(key), slots))
    return kept.join(F.broadcast(lookup(rows.sparkSession, fill(names, slots))), "slot", "left")


def write_shards(rows: DataFrame, path: str, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> None:
    """Write rows by shard, one folder each. A shard's rows are dealt to several tasks by slot, so none holds a whole shard."""
    placed = place(rows, key, shards, slots)
    placed.repartition(F.col("shard"), F.col("slot")).write.partitionBy("shard").parquet(path)


def shard_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars_seen (characters of the whole text, 0 for null), slot, shard for each row."""
    seen = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    return place(docs.select("doc_id", seen.alias("n_chars_seen"))).select("doc_id", "n_chars_seen", "slot", "shard")


def oracle() -> str:
    """The placement in DuckDB SQL. The table's filling, one turn after the other, is tested against a brute-force version instead."""
    filled = fill([f"shard-{i}" for i in range(SHARDS)], SLOTS)
    return f"""
with final as (select [{", ".join(map(str, filled))}] as tab)
select doc_id, coalesce(length(text), 0)::bigint as n_chars_seen,
       (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint % {SLOTS})::integer as slot,
       tab[(('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint % {SLOTS}) + 1]::integer as shard
from documents, final"""
