"""Shard placement by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size,
given by an offset and a step; shards take turns claiming the next free slot
of their permutation until the table is full.  Every shard then owns the same
number of slots (one more or less), and taking a shard away moves few keys
besides its own.  The table has ``size`` rows, a parameter that no input can
change, so it is broadcast; a key is placed by one hash and one lookup.

Edge cases: null keys are placed like the text '<null>'; every input row gives
one output row, repeated rows included; other columns pass through untouched
(:func:`place`) or are ignored (:func:`shard_documents`); an empty table gives
an empty table.  ``shards`` must be distinct names, fewer than ``size``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 65_537  # prime
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> list[int]:
    """Owner (index into ``shards``) of each slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) >= size:
        raise ValueError("shards must be distinct, at least one and fewer than the slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be prime")
    place = [_number(s, "offset") % size for s in shards]
    step = [_number(s, "step") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    left = size
    while left:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % size
            owner[place[i]] = i
            left -= 1
            if not left:
                break
    return owner


def slot_of(key: Column, size: int = SIZE) -> Column:
    """Slot of a key: 60 bits of its MD5 modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit("<null>"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(size)


def table(spark, shards: tuple[str, ...] = SHARDS, size: int = SIZE, name: str = "shard") -> DataFrame:
    """The lookup table as rows (slot, ``name``)."""
    owners = ",".join(map(str, fill_table(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    return (spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_slot", "_owner"))
            .select(F.col("_slot").cast("long").alias("_slot"),
                    F.element_at(names, F.col("_owner").cast("int") + 1).alias(name)))


def place(df: DataFrame, key: Column, shards: tuple[str, ...] = SHARDS, size: int = SIZE, name: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of each row (columns ``slot`` and ``name``)."""
    keyed = df.withColumn("slot", slot_of(key, size))
    owners = F.broadcast(table(df.sparkSession, shards, size, name))  # `size` rows, by construction
    return keyed.join(owners, keyed["slot"] == owners["_slot"], "left").drop("_slot")


def write_shards(df: DataFrame, key: Column, path: str, shards: tuple[str, ...] = SHARDS, files_per_shard: int = 4) -> None:
    """Write one folder per shard, each from ``files_per_shard`` tasks, so no
    task holds a whole shard."""
    placed = place(df, key, shards)
    part = F.pmod(F.xxhash64(key.cast("string")), F.lit(files_per_shard))
    (placed.repartition(len(shards) * files_per_shard, "shard", part)
     .drop("slot").write.mode("overwrite").partitionBy("shard").parquet(path))


def shard_documents(docs: DataFrame, shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """Per document: doc_id, slot, shard, and ``shard_after_loss``: where it
    goes once the last shard is gone (equal for nearly all keys that the last
    shard did not hold)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    now = place(ids, F.col("doc_id"), shards, size)
    if len(shards) == 1:
        return now.withColumn("shard_after_loss", F.lit(None).cast("string"))
    later = F.broadcast(table(ids.sparkSession, shards[:-1], size, "shard_after_loss"))
    return now.join(later, now["slot"] == later["_slot"], "left").drop("_slot")


def oracle_sql(shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> str:
    """DuckDB SQL for :func:`shard_documents` (the filled tables as lists)."""
    def owners(names):
        return "[" + ",".join(map(str, fill_table(names, size))) + "]"
    names = "[" + ",".join(f"'{s}'" for s in shards) + "]"
    return (f"WITH t AS (SELECT {owners(shards)} AS a, {owners(shards[:-1])} AS b, {names} AS s), "
            f"k AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '<null>')), 1, 15) AS BIGINT) % {size} AS slot "
            "FROM documents) SELECT doc_id, slot, s[a[slot + 1] + 1] AS shard, s[b[slot + 1] + 1] AS shard_after_loss FROM k, t")
