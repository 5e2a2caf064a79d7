"""The driver's order tables seen as transactions of accounts, products and branches."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BEFORE, AFTER = "day1", "day2"
#: Business date of the later batch.
AFTER_DATE = dt.date(2026, 10, 1)
KYC = ("Verified", "Pending", "Rejected")
PRODUCT_TYPES = ("Savings Account", "Loan", "Credit Card", "Fixed Deposit")


@dataclass(frozen=True)
class Star:
    lines: DataFrame
    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    branches: DataFrame

    @property
    def facts(self) -> DataFrame:
        return _facts(self.lines, self.orders)

    def txn(self, *dimensions: str) -> DataFrame:
        """The facts with the attributes of the named dimensions."""
        from .kpi import point_in_time

        return point_in_time(_facts(self.lines, self.orders, **{d: getattr(self, d) for d in dimensions}))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(letter: str, key: str) -> Column:
    return F.concat(F.lit(letter), F.col(key).cast("string"))


def pick(names: tuple[str, ...], key: str) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (F.col(key) % len(names) + 1).cast("int"))


def batch(key: str, every: int) -> Column:
    return F.when(F.col(key) % every == 0, AFTER).otherwise(BEFORE)


def _versions(df: DataFrame) -> DataFrame:
    return df.withColumns({"valid_from": F.lit(dt.date(1900, 1, 1)), "valid_to": F.lit(dt.date(9999, 12, 31)), "is_current": F.lit(1)})


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return _versions(c.select(
        F.col("c_custkey").alias("customer_sk"), keyed("C", "c_custkey").alias("customer_id"), keyed("A", "c_custkey").alias("account_id"), F.col("c_name").alias("customer_name"),
        pick(KYC, "c_custkey").alias("kyc_status"), F.col("c_mktsegment").alias("address"), batch("c_custkey", 10).alias("batch_id"),
    ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _versions(p.select(
        F.col("p_partkey").alias("product_sk"), keyed("P", "p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), pick(PRODUCT_TYPES, "p_size").alias("product_type"),
        F.col("p_brand").alias("category"), F.col("p_retailprice").cast("decimal(15,2)").alias("price"), batch("p_partkey", 50).alias("batch_id"),
    ))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    joined = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return _versions(joined.select(
        F.col("s_suppkey").alias("branch_sk"), keyed("B", "s_suppkey").alias("branch_id"), F.col("s_name").alias("branch_name"), F.col("r_name").alias("region"), batch("s_suppkey", 25).alias("batch_id"),
    ))


def _facts(l: DataFrame, o: DataFrame, customers: DataFrame | None = None, products: DataFrame | None = None, branches: DataFrame | None = None) -> DataFrame:
    """A fact for each line: finished orders succeed, open ones are pending, others failed; heavily taxed lines are foreign.

    Attributes of customers are joined to the orders, which are fewer than lines. What is shuffled
    are short numbers: a line's amount and flags are made before the joins, the texts of a fact after all.
    """
    amount, foreign = F.col("_amount"), F.col("_foreign")
    made = [F.col("l_extendedprice").cast("decimal(15,2)").alias("_amount"), (F.col("l_tax") > 0.07).alias("_foreign"), (F.col("l_returnflag") == "R").cast("int").alias("_refund")]
    l = l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *made)
    status = F.when(F.col("o_orderstatus") == "F", "Success").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Failed")
    named: list[str] = []

    def with_attributes(rows: DataFrame, key: str, dimension: DataFrame | None, sk: str, *attributes: str) -> DataFrame:
        if dimension is None:
            return rows
        named.extend(attributes)
        return rows.join(dimension.select(F.col(sk).alias("_sk"), *attributes), F.col(key) == F.col("_sk")).drop("_sk")

    o = with_attributes(o, "o_custkey", customers, "customer_sk", "customer_name", "kyc_status")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = with_attributes(rows, "l_partkey", products, "product_sk", "product_name", "product_type", "category")
    rows = with_attributes(rows, "l_suppkey", branches, "branch_sk", "branch_name", "region")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"), keyed("A", "o_custkey").alias("account_id"), keyed("C", "o_custkey").alias("customer_id"),
        keyed("P", "l_partkey").alias("product_id"), keyed("B", "l_suppkey").alias("branch_id"), F.col("o_custkey").alias("customer_sk"), F.col("l_partkey").alias("product_sk"), F.col("l_suppkey").alias("branch_sk"),
        F.col("o_orderdate").alias("txn_ts"), F.col("o_orderdate").cast("date").alias("txn_date"), amount.alias("amount"), F.when(foreign, "USD").otherwise("INR").alias("currency"),
        F.when(~foreign, amount).alias("amount_inr"), status.alias("status"), F.col("_refund").alias("is_refund"), batch("o_orderkey", 20).alias("source_batch_id"), *named,
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), *(part(spark, sf_dir) for part in (customers, products, branches)))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as successful rupee transactions of its users."""
    e = table(spark, sf_dir, "events")
    amount = F.col("value").cast("decimal(15,2)")
    return e.select(
        F.col("event_id").alias("transaction_id"), keyed("A", "user_id").alias("account_id"), keyed("C", "user_id").alias("customer_id"), F.col("event_type").alias("customer_name"),
        F.col("ts").alias("txn_ts"), amount.alias("amount"), amount.alias("amount_inr"), F.lit("INR").alias("currency"), F.lit("Success").alias("status"),
    )
