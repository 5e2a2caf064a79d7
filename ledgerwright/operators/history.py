"""Versioned dimensions, point-in-time joins, and facts that late corrections may change."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import canonical, row_hash

FIRST, OPEN = dt.date(1900, 1, 1), dt.date(9999, 12, 31)
Stage = Callable[[DataFrame], DataFrame]
SCD = ["valid_from", "valid_to", "is_current", "row_hash", "batch_id"]


def batch_order(column: Column, batches: list[str]) -> Column:
    """A batch's place in the calendar; unknown ones come before all."""
    if not batches:
        return F.lit(-1)
    pairs = [F.lit(x) for k, b in enumerate(batches) for x in (b, k)]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), F.lit(-1))


def hashed(records: DataFrame, columns: list[str]) -> DataFrame:
    """records with row_hash over some columns."""
    kinds = dict(records.dtypes)
    return records.withColumn("row_hash", row_hash([(c, kinds[c]) for c in columns]))


def merge_versions(history: DataFrame, records: DataFrame, key: str, tracked: list[str], batch_id: str, batch_date: dt.date, batches: list[str], stage: Stage = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(new history, actions): records merged into a dimension's versions, in one join on the key.

    history: key, attributes and SCD columns. An absent key is inserted as known since always.
    A record whose hash is that of the current version is unchanged; one of an earlier batch than
    that version's is skipped; a change of a tracked column closes the version at the batch's
    date and opens a new one; any other change is made in place. actions: (action, n).
    stage: writes the joined rows, from which both results are read, so that the join runs once.
    """
    attributes = [c for c in history.columns if c != key and c not in SCD]
    new = hashed(records.select(key, *attributes), attributes)
    new = new.select(F.struct(key, *attributes, "row_hash").alias("new"), F.col(key).alias("_key"))
    current = history.where("is_current = 1").select(F.struct(*history.columns).alias("old"), F.col(key).alias("_key"))
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    action = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "inserted")
        .when(F.col("old.row_hash") == F.col("new.row_hash"), "unchanged")
        .when(batch_order(F.lit(batch_id), batches) < batch_order(F.col("old.batch_id"), batches), "skipped_newer_exists")
        .when(changed, "new_version")
        .otherwise("updated_in_place")
    )
    joined = stage(current.join(new, "_key", "full_outer").withColumn("action", action))

    def version(source: str, valid_from: Column, valid_to: Column, is_current: int, hash_: Column, batch: Column) -> Column:
        values = [F.col(f"{source}.{c}").alias(c) for c in (key, *attributes)]
        scd = [valid_from.cast("date").alias("valid_from"), valid_to.cast("date").alias("valid_to"), F.lit(is_current).alias("is_current"), hash_.alias("row_hash"), batch.alias("batch_id")]
        return F.struct(*values, *scd)

    old_from, old_hash, old_batch = F.col("old.valid_from"), F.col("old.row_hash"), F.col("old.batch_id")
    stays = version("old", old_from, F.col("old.valid_to"), 1, old_hash, old_batch)
    closed = version("old", old_from, F.lit(batch_date), 0, old_hash, old_batch)
    opened = lambda start: version("new", start, F.lit(OPEN), 1, F.col("new.row_hash"), F.lit(batch_id))
    versions = (
        F.when(F.col("action") == "inserted", F.array(opened(F.lit(FIRST))))
        .when(F.col("action") == "new_version", F.array(closed, opened(F.lit(batch_date))))
        .when(F.col("action") == "updated_in_place", F.array(opened(old_from)))
        .otherwise(F.array(stays))
    )
    rebuilt = joined.select(F.explode(versions).alias("v")).select("v.*").select(*history.columns)
    actions = joined.where("action <> 'kept'").groupBy("action").agg(F.count("*").alias("n"))
    return history.where("is_current = 0").unionByName(rebuilt), actions


def with_surrogate(history: DataFrame, key: str, name: str) -> DataFrame:
    """history with a surrogate key: a hash of key and start, so the same on every run and without a global sort."""
    return history.withColumn(name, F.xxhash64(key, "valid_from"))


def as_of(facts: DataFrame, versions: DataFrame, fact_key: str, key: str, day: str, take: dict[str, str], marker: str) -> DataFrame:
    """facts joined with the version of a key that was valid on a day (valid_from <= day < valid_to).

    take: version column -> name. `marker` tells how many versions matched. If several do (an
    account that two customers had), the latest start and then the smallest taken values count.
    An equality on the key carries the join; the interval is checked within it.
    """
    side = versions.select(F.col(key).alias("_vk"), F.col("valid_from").alias("_vf"), F.col("valid_to").alias("_vt"), F.struct(F.lit(1).alias("_"), *[F.col(c).alias(n) for c, n in take.items()]).alias("_take"))
    dense = side.groupBy("_vk").agg(F.collect_list(F.struct((-F.unix_date("_vf")).alias("late"), "_vf", "_vt", "_take")).alias("_versions"))
    valid = F.filter("_versions", lambda v: (v["_vf"] <= F.col(day)) & (F.col(day) < v["_vt"]))
    joined = facts.join(dense, F.col(fact_key) == F.col("_vk"), "left").withColumn("_valid", valid)
    best = F.array_min("_valid")
    chosen = [best["_take"][n].alias(n) for n in take.values()]
    return joined.select(*[c for c in facts.columns], *chosen, F.coalesce(F.size("_valid"), F.lit(0)).alias(marker))


def upsert_facts(facts: DataFrame, records: DataFrame, key: str, hashed_columns: list[str], extra: list[str], batch_id: str, batches: list[str], stage: Stage = lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new facts, actions, corrections): records merged into the facts in one join on the key.

    An absent key is inserted; an equal hash is unchanged; a record older than the fact's last
    change is skipped; else the fact is corrected and the changed columns are logged with their
    old and new text. `extra` columns (surrogate keys) follow a correction but are not hashed.
    stage: writes the joined rows, from which all three results are read, so that the join runs once.
    """
    columns = facts.columns
    new = hashed(records.select(key, *hashed_columns, *extra), hashed_columns)
    new = new.select(F.col(key).alias("_key"), F.struct("*").alias("new"))
    old = facts.select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    action = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "inserted")
        .when(F.col("old.row_hash") == F.col("new.row_hash"), "unchanged")
        .when(batch_order(F.lit(batch_id), batches) < batch_order(F.col("old.last_updated_batch_id"), batches), "skipped_newer_exists")
        .otherwise("corrected")
    )
    joined = stage(old.join(new, "_key", "full_outer").withColumn("action", action))
    takes = F.col("action").isin("inserted", "corrected")
    kinds = dict(facts.dtypes)
    values = []
    for c in columns:
        if c == "source_batch_id":
            value = F.when(F.col("action") == "inserted", F.lit(batch_id)).otherwise(F.col(f"old.{c}"))
        elif c == "last_updated_batch_id":
            value = F.when(takes, F.lit(batch_id)).otherwise(F.col(f"old.{c}"))
        else:
            value = F.when(takes, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        values.append(value.cast(kinds[c]).alias(c))
    texts = lambda side: F.create_map(*[x for c in hashed_columns for x in (F.lit(c), canonical(F.col(f"{side}.{c}"), kinds[c]))])
    before, after = texts("old"), texts("new")
    differs = lambda k, _: ~F.element_at(before, k).eqNullSafe(F.element_at(after, k))
    log = joined.where("action = 'corrected'").select(
        F.col("_key").alias(key), F.lit(batch_id).alias("batch_id"), F.map_filter(before, differs).alias("old_values"), F.map_filter(after, differs).alias("new_values")
    )
    actions = joined.where("action <> 'kept'").groupBy("action").agg(F.count("*").alias("n"))
    return joined.select(*values), actions, log


def touched_parts(facts: DataFrame, records: DataFrame, key: str, part: Column) -> DataFrame:
    """The parts that an upsert of records may change: those of the facts they meet, and their own.

    Of the facts only the key and what gives the part are read.
    """
    met = facts.join(records.select(key), key, "left_semi").select(part.alias("part"))
    return met.unionByName(records.select(part.alias("part"))).distinct()


def earliest(df: DataFrame, key: str, *order) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_first", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_first = 1").drop("_first")
