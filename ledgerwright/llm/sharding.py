"""Sharding by a permutation-filled lookup table, in DataFrame operations only."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots for each shard; shards differ by one slot, so by 1 % of a shard's share at most.
SLOTS_PER_SHARD = 100


def table_size(shards: int, slots_per_shard: int = SLOTS_PER_SHARD) -> int:
    """The smallest prime of at least slots_per_shard slots for each shard."""
    n = max(2, shards * slots_per_shard)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def fill_table(shards: Sequence[str], size: int) -> list[int]:
    """The shard index in each slot.

    Each shard prefers the slots in an order of its own (offset + k * skip, modulo a prime size,
    so it meets every slot). Shards take turns and claim the first slot of their order that is
    free. Adding or losing a shard moves little more than that shard's share.
    """
    if not shards:
        raise ValueError("at least one shard is needed")
    digest = [hashlib.md5(s.encode()).hexdigest() for s in shards]
    at = [int(d[:8], 16) % size for d in digest]
    skip = [int(d[8:16], 16) % (size - 1) + 1 for d in digest]
    table, left = [-1] * size, size
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def table_frame(spark: SparkSession, shards: Sequence[str], size: int) -> DataFrame:
    """(shard_slot, shard): as many rows as slots, made inside the plan."""
    text = ",".join(map(str, fill_table(shards, size)))
    names = F.array(*map(F.lit, shards))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ","))).select(
        F.col("pos").alias("shard_slot"), F.element_at(names, F.col("col").cast("int") + 1).alias("shard")
    )


def slot_of(key: Column, size: int) -> Column:
    """A key's slot: its MD5's first 8 digits modulo the table's size; a null key counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % size).cast("int")


def assign_shards(
    docs: DataFrame, shards: Sequence[str] | int, *, id_col: str = "doc_id", slots_per_shard: int = SLOTS_PER_SHARD
) -> DataFrame:
    """docs with `shard_slot` and `shard` (columns of these names are replaced).

    The table is broadcast: it has one short row per slot, a number fixed by the shards alone,
    so rows are placed where they are read, without a shuffle. Rows with the same id go to the
    same shard; choose an id that no third of the rows share. A null id counts as empty text.
    No other column is looked at, texts of any length are carried along, and an empty table gives an empty result.
    """
    names = [f"shard-{i:05d}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    size = table_size(len(names), slots_per_shard)
    table = table_frame(docs.sparkSession, names, size)
    own = docs.drop(*[c for c in ("shard_slot", "shard") if c != id_col])
    return own.withColumn("shard_slot", slot_of(F.col(id_col), size)).join(F.broadcast(table), "shard_slot", "left")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str] | int, *, files_per_shard: int = 1, **options) -> None:
    """A folder shard=<name> for each shard, of `files_per_shard` files each (more for large shards)."""
    placed = assign_shards(docs, shards, **options)
    id_col = options.get("id_col", "doc_id")
    part = F.pmod(F.xxhash64(id_col), F.lit(files_per_shard))
    placed.repartition("shard", part).drop("shard_slot").write.partitionBy("shard").mode("errorifexists").parquet(path)
