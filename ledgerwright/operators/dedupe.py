"""Duplicates, conflicts, ownership and references: each record gets exactly one disposition.

The dispositions are passed, rejected and duplicate. Every step is one window or join over keys,
and nothing is gathered on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.readers import LOST, POSITION, RAW
from .cleaners import FLAGS, REJECTS, Entity, clean

PASSED, REJECTED, DUPLICATE = "passed", "rejected", "duplicate"
DISPOSITION, COUNTED = "_disposition", "_counted_flags"


def mark_exact_duplicates(rows: DataFrame, key: str = RAW, order: str = POSITION) -> DataFrame:
    """rows with _copy: 1 for the first of equal records, 2 and up for its repetitions.

    Records are compared by their SHA-256, so what is sorted is short however long they are.
    """
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy(F.sha2(F.col(key).cast("binary"), 256)).orderBy(order)))


def mark_conflicts(rows: DataFrame, key: str) -> DataFrame:
    """rows with _conflict: whether another record has the same key.

    Keys are counted where the records lie and the counts are joined, so that a key of very many
    records (a blank one) is split among tasks.
    """
    repeated = rows.groupBy(F.col(key).alias("_repeated")).count().where("count > 1")
    return rows.join(repeated, F.col(key).eqNullSafe(F.col("_repeated")), "left").withColumn("_conflict", F.col("count").isNotNull()).drop("_repeated", "count")


def mark_best_copy(rows: DataFrame, key: str, flags: str = FLAGS, order: str = POSITION) -> DataFrame:
    """rows with _rank: 1 for the copy of a key with the fewest flags, the later of equal ones."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.size(flags), F.desc(order))))


def mark_owner(rows: DataFrame, account: str, registered: str, customer: str) -> DataFrame:
    """rows with _owner: whether the customer registered the account first (unknown dates last, then by id)."""
    order = [F.coalesce(registered, F.lit(dt.date(9999, 12, 31))), F.col(customer)]
    return rows.withColumn("_owner", F.row_number().over(Window.partitionBy(account).orderBy(*order)) == 1)


def settle(rows: DataFrame, entity: Entity, batch_date: dt.date) -> DataFrame:
    """Every record of a file with its clean columns, reasons, disposition and the flags that count.

    Flags of records that a cleaner rejects count; flags of records that lose to another copy,
    conflict or another owner do not, and have their own code instead. Records are compared as
    short rows, one for each different record; the records themselves shuffle once, to learn from
    their row what became of them. A record without such a row repeats an earlier one.
    """
    cleaned = clean(rows, entity, batch_date).withColumn("_hash", F.sha2(F.col(RAW).cast("binary"), 256))
    verdicts = _verdicts(cleaned, entity)
    found = cleaned.join(verdicts, (F.col("_hash") == F.col("_of")) & (F.col(POSITION) == F.col("_first")), "left")
    none = F.array().cast("array<string>")
    codes = lambda code: F.array(F.lit(code))
    bare = F.lit(None).cast(cleaned.schema["clean"].dataType)
    fragment = F.to_json(F.struct(F.col(LOST).alias("fragment")))

    def outcome(disposition, rejects, counted, values=F.col("clean"), key=F.col("_key"), record=F.col(RAW)):
        key = F.nullif(F.substring(key, 1, 50), F.lit(""))
        return F.struct(record.alias(RAW), key.alias("record_key"), values.alias("clean"), rejects.alias(REJECTS), F.lit(disposition).alias(DISPOSITION), counted.alias(COUNTED))

    settled = (
        F.when(F.col(LOST).isNotNull(), outcome(REJECTED, codes("MALFORMED_JSON"), none, bare, F.lit(""), fragment))
        .when(F.col("_of").isNull(), outcome(DUPLICATE, none, codes("EXACT_DUPLICATE"), bare))
        .when(F.col("_verdict") == "CONFLICTING_DUPLICATE", outcome(REJECTED, codes("CONFLICTING_DUPLICATE"), none, bare))
        .when(F.size(REJECTS) > 0, outcome(REJECTED, F.col(REJECTS), F.col(FLAGS)))
        .when(F.col("_verdict") == "NEAR_DUPLICATE_RESOLVED", outcome(DUPLICATE, none, codes("NEAR_DUPLICATE_RESOLVED"), key=F.col(f"clean.{entity.key}")))
        .when(F.col("_verdict") == "SHARED_ACCOUNT_ID", outcome(REJECTED, codes("SHARED_ACCOUNT_ID"), none))
        .otherwise(outcome(PASSED, none, F.col(FLAGS)))
    )
    return found.select(POSITION, settled.alias("_settled")).select(POSITION, "_settled.*")


def _verdicts(cleaned: DataFrame, entity: Entity) -> DataFrame:
    """(_of, _first, _verdict): each different record's hash, its first place, and the code of what it loses by, if it does."""
    good = F.size(REJECTS) == 0
    facts = {"_id": F.col(f"clean.{entity.key}"), "_good": good}
    if entity.name == "customers":
        facts |= {"_holds": F.col("clean.account_id"), "_registered": F.col("clean.registration_date")}
    each = cleaned.where(F.col(LOST).isNull()).groupBy(F.col("_hash").alias("_of"), "_key", FLAGS, *[c.alias(n) for n, c in facts.items()]).agg(F.min(POSITION).alias("_first"))
    if entity.name == "transactions":
        verdict = F.when(F.col("_conflict"), "CONFLICTING_DUPLICATE")
        return mark_conflicts(each, "_key").select("_of", "_first", verdict.alias("_verdict"))
    # records that are out of a comparison are a group of their own in it
    among = lambda takes_part, key: F.when(takes_part, F.concat(F.lit("key "), key)).otherwise(F.concat(F.lit("record "), F.col("_of")))
    ranked = mark_best_copy(each.withColumn("_among", among(F.col("_good"), F.col("_id"))), "_among", order="_first")
    verdict = F.when(F.col("_rank") > 1, "NEAR_DUPLICATE_RESOLVED")
    if entity.name == "customers":
        ranked = mark_owner(ranked.withColumn("_among", among(F.col("_good") & (F.col("_rank") == 1), F.col("_holds"))), "_among", "_registered", "_id")
        verdict = verdict.when(~F.col("_owner"), "SHARED_ACCOUNT_ID")
    return ranked.select("_of", "_first", verdict.alias("_verdict"))


def check_references(settled: DataFrame, references: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """settled, where passed records with an unknown reference become rejected, with a reason for each.

    references: reason -> (column of clean, a frame of one column with the known keys). Counted flags stay.
    """
    out = settled
    hits = []
    for k, (_, (column, known)) in enumerate(references.items()):
        keys = known.select(F.col(known.columns[0]).alias(f"_known{k}")).where(F.col(f"_known{k}").isNotNull()).distinct()
        out = out.join(keys, F.col(f"clean.{column}") == F.col(f"_known{k}"), "left")
        hits.append(F.col(f"_known{k}").isNotNull())
    orphan = F.array_compact(F.array(*[F.when(~hit, F.lit(reason)) for reason, hit in zip(references, hits, strict=True)]))
    passed = F.col(DISPOSITION) == PASSED
    judged = out.withColumn(REJECTS, F.when(passed, orphan).otherwise(F.col(REJECTS)))
    return judged.withColumn(DISPOSITION, F.when(passed & (F.size(REJECTS) > 0), REJECTED).otherwise(F.col(DISPOSITION))).select(*settled.columns)


def clean_records(settled: DataFrame) -> DataFrame:
    return settled.where(F.col(DISPOSITION) == PASSED).select("clean.*")


def quarantine(settled: DataFrame) -> DataFrame:
    """(record_key, reason_codes, raw_record) of what is rejected."""
    rejected = settled.where(F.col(DISPOSITION) == REJECTED)
    return rejected.select("record_key", F.array_join(REJECTS, ";").alias("reason_codes"), F.col(RAW).alias("raw_record"))


def issue_counts(settled: DataFrame, *by: str) -> DataFrame:
    """(severity, reason_code, record_count), for each value of the columns `by`."""
    codes = lambda severity, column: F.transform(column, lambda c: F.struct(F.lit(severity).alias("severity"), c.alias("reason_code")))
    each = settled.select(*by, F.explode(F.concat(codes("REJECT", F.col(REJECTS)), codes("FLAG", F.col(COUNTED)))).alias("x"))
    return each.groupBy(*by, "x.severity", "x.reason_code").agg(F.count("*").alias("record_count"))


def scorecard(settled: DataFrame, *by: str) -> DataFrame:
    """Records received, passed and rejected, and duplicates removed: one row, or one for each value of the columns `by`."""
    many = lambda d: F.count_if(F.col(DISPOSITION) == d)
    return settled.groupBy(*by).agg(F.count("*").alias("records_received"), many(PASSED).alias("records_passed"), many(REJECTED).alias("records_rejected"), many(DUPLICATE).alias("duplicates_removed"))
