"""The queries behind reports: totals, pivots, filters, safe export, profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import safe_cell, shape
from .kpi import money, percent, valued


def totals(txn: DataFrame, scorecard: DataFrame | None = None) -> DataFrame:
    """One row: facts, valued net, and with a scorecard the records' sums and their pass rate."""
    out = txn.agg(F.count("*").alias("facts")).crossJoin(valued(txn).agg(F.count("*").alias("valued"), money(F.sum("net_inr")).alias("net_value_inr")))
    if scorecard is None:
        return out
    sums = scorecard.agg(*[F.sum(c).alias(c) for c in ("records_received", "records_passed", "records_rejected", "duplicates_removed")])
    return out.crossJoin(sums.withColumn("pass_rate_pct", percent(F.col("records_passed"), F.col("records_received"), 1)))


def pivot(df: DataFrame, rows: str, columns: str, value: str, names: list[str]) -> DataFrame:
    """Sums of value with a column for each of the stated names; stating them saves a job and fixes the schema."""
    return df.groupBy(rows).pivot(columns, names).agg(money(F.sum(value)))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def reason_counts(df: DataFrame, column: str, reasons: list[str]) -> DataFrame:
    """How many rows name each reason, in one pass over the rows."""
    counted = df.agg(*[F.count_if(F.col(column).contains(r)).alias(r) for r in reasons])
    pairs = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in reasons])
    return counted.select(F.explode(pairs).alias("x")).select("x.*")


def any_reason(df: DataFrame, column: str, reasons: list[str]) -> DataFrame:
    found = F.lit(False)
    for r in reasons:
        found = found | F.col(column).contains(r)
    return df.where(found)


def search(df: DataFrame, needle: str, columns: list[str]) -> DataFrame:
    """Rows in which any column holds the text, whatever its case, taken literally."""
    found = F.lit(False)
    for c in columns:
        found = found | F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(needle.lower())
    return df.where(found)


def safe_csv(df: DataFrame) -> DataFrame:
    return df.select(*[safe_cell(F.col(c)).alias(c) for c in df.columns])


def profile(df: DataFrame, top: int = 8) -> DataFrame:
    """A row for each column and one of its commonest shapes: rows, blanks, distinct values, shape, how often.

    All columns are counted in one pass: cells are reduced to (column, value) counts where they are read.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in df.columns]))
    values = df.select(cells.alias("x")).groupBy("x.name", "x.value").agg(F.count("*").alias("n"))
    columns = values.groupBy("name").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.trim("value") == "", F.col("n")).otherwise(0)).alias("blanks"), F.count_if(F.trim("value") != "").alias("n_distinct"))
    shapes = values.groupBy("name", shape(F.col("value")).alias("shape")).agg(F.sum("n").alias("shape_n"))
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("shape_n"), "shape"))
    return shapes.withColumn("shape_rank", rank.cast("long")).where(F.col("shape_rank") <= top).join(columns, "name").withColumnRenamed("name", "column_name")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, rows that repeat another one, and rows whose key another row has had."""
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    counted = df.agg(F.count("*").alias("n_rows"), F.count_distinct(whole).alias("_rows"), F.count(key).alias("_keyed"), F.count_distinct(key).alias("_keys"))
    return counted.select("n_rows", (F.col("n_rows") - F.col("_rows")).alias("repeated_rows"), (F.col("_keyed") - F.col("_keys")).alias("repeated_keys"))


def listing(df: DataFrame, *order: str) -> DataFrame:
    """Rows as a report lists them: each of order is a column, or one with DESC or DESC NULLS LAST."""
    return df.orderBy(*map(_ordering, order))


def _ordering(order: str):
    column, _, rest = order.partition(" ")
    by = {"": F.asc, "DESC": F.desc, "DESC NULLS LAST": F.desc_nulls_last}[rest]
    return by(column)


def placed(df: DataFrame, *order: str) -> DataFrame:
    """A report's rows with their place in it. The window holds all rows: reports list few."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(*map(_ordering, order))).cast("long"))


def at_risk(exposure: DataFrame) -> DataFrame:
    """One row: the share of transactions and of value of customers that aren't verified, and that value."""
    sums = {"share_of_count_pct": "count_pct", "share_of_value_pct": "value_pct"}
    rounded = [F.round(F.sum(c), 1).alias(name) for c, name in sums.items()]
    return exposure.where("at_risk").agg(*rounded, money(F.sum("value_inr")).alias("value_inr"))


def value_listing(df: DataFrame, most: int = 15) -> DataFrame:
    """(column_name, value, n) of the columns that have at most `most` distinct values, blank ones aside."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("value")) for c in df.columns]))
    values = df.select(cells.alias("x")).groupBy("x.column_name", "x.value").agg(F.count("*").alias("n"))
    few = values.where(F.trim("value") != "").groupBy("column_name").agg(F.count("*").alias("many")).where(F.col("many") <= most)
    return values.join(F.broadcast(few), "column_name").select("column_name", "value", "n")  # a row for each column


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that several rows have, and how many."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


class Cache:
    """Results that are kept while the published version they come from is the latest."""

    def __init__(self, store):
        self.store, self.version, self.held = store, None, {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        version = self.store.latest()
        if version != self.version:
            self.clear()
            self.version = version
        if name not in self.held:
            self.held[name] = build().persist()
        return self.held[name]

    def clear(self) -> None:
        for df in self.held.values():
            df.unpersist()
        self.held = {}
