"""Where in a table a key may be, told from short summaries of its parts' keys instead of the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key at least: a block is 512, and a part's blocks are a power of two.
KEY_BITS = 16
WORDS = 8
#: A part has at least 2**LEAST_LEVEL places for blocks, so that keys of small parts are many groups too; empty blocks aren't kept.
LEAST_LEVEL = 10
COLUMNS = "held_in string, level int, block bigint, " + ", ".join(f"w{k} bigint" for k in range(WORDS))


def schema(key_type: str) -> str:
    return f"{COLUMNS}, first_key {key_type}, last_key {key_type}"


def _masks(key: Column) -> list[Column]:
    """One bit of each word of a block."""
    bits = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * k).bitwiseAND(63).cast("int")) for k in range(WORDS)]


def _block(key: Column, level: Column) -> Column:
    """The first `level` bits of a key's hash."""
    return F.call_function("shiftrightunsigned", F.xxhash64(key), F.lit(64) - level)


def summaries(rows: DataFrame, key: str, part: Column) -> DataFrame:
    """Blocks of a Bloom filter over the keys of each part, with the part's least and greatest key.

    A part of n keys has 2**level places, the least that give each key KEY_BITS bits, so a key not in it
    passes once in 1,700 times or less. Null keys are in no part. Bits are set where rows lie and
    merged by block, so a part of very many rows is many tasks.
    """
    keys = rows.select(part.cast("string").alias("held_in"), F.col(key).alias("key")).where("key IS NOT NULL")
    spans = keys.groupBy("held_in").agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count("*").alias("n"))
    least = F.ceil(F.log2(F.col("n") * KEY_BITS / (64 * WORDS))).cast("int")
    spans = spans.select("held_in", F.greatest(F.lit(LEAST_LEVEL), least).alias("level"), "first_key", "last_key")
    # a row for each part, whose names the writer of these parts holds anyway
    placed = keys.join(F.broadcast(spans), "held_in").withColumn("block", _block(F.col("key"), F.col("level")))
    words = [F.bit_or(m).alias(f"w{k}") for k, m in enumerate(_masks(F.col("key")))]
    merged = placed.groupBy("held_in", "level", "block").agg(*words, F.first("first_key").alias("first_key"), F.first("last_key").alias("last_key"))
    return merged.select("held_in", "level", "block", *[f"w{k}" for k in range(WORDS)], "first_key", "last_key")


def may_hold(index: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """(held_in): the parts that may hold some key of the records; none that holds one is missing.

    Parts whose keys all lie outside the records' range aren't read: the bounds reach the scan. The
    rest meet by block, where a key must lie in the part's own range and have all its bits set.
    """
    wanted = records.select(F.col(key).cast(index.schema["first_key"].dataType).alias("key")).where("key IS NOT NULL").distinct()
    least, greatest = wanted.agg(F.min("key"), F.max("key")).first()
    if least is None:
        return index.select("held_in").where("false")
    near = index.where((F.col("first_key") <= F.lit(greatest)) & (F.col("last_key") >= F.lit(least)))
    # at most one number for each power of two
    levels = [r["level"] for r in near.select("level").distinct().collect()]
    if not levels:
        return index.select("held_in").where("false")
    placed = wanted.withColumn("level", F.explode(F.array(*map(F.lit, sorted(levels)))))
    placed = placed.withColumn("block", _block(F.col("key"), F.col("level")))
    inside = F.col("key").between(F.col("first_key"), F.col("last_key"))
    for k, mask in enumerate(_masks(F.col("key"))):
        inside = inside & (F.col(f"w{k}").bitwiseAND(mask) != 0)
    return near.join(placed, ["level", "block"]).where(inside).select("held_in").distinct()
