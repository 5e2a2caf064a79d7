"""Every query by name, over the driver's tables; oracles.py has the SQL of the same names."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import text as tx
from ..operators import dedupe, history, keys
from ..operators.cleaners import ENTITIES, REJECTS
from ..sources import json_scan, readers
from . import kpi, serving
from .star import AFTER, AFTER_DATE, BEFORE, batch, customers, events, facts, keyed, pick, star, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def star_txn(spark, d):
    columns = ["transaction_id", "account_id", "txn_date", "month_start", "quarter", "amount_inr", "net_inr", "status", "customer_name", "kyc_status", "product_type", "category", "branch_name", "region"]
    return star(spark, d).txn("customers", "products", "branches").select(*columns)


@query
def kpi01_top_customers(spark, d):
    s = star(spark, d)
    return kpi.top_customers(s.txn(), s.customers)


for _name, _plan, _dimension in (
    ("kpi02_branch_monthly", kpi.branch_monthly, "branches"), ("kpi02_region_monthly", kpi.region_monthly, "branches"), ("kpi03_product_revenue", kpi.product_revenue, "products"),
    ("kpi07_branch_ranking", kpi.branch_ranking, "branches"), ("kpi08_kyc_exposure", kpi.kyc_exposure, "customers"), ("kpi09_refund_by_product", kpi.refunds_by_product, "products"), ("kpi09_refund_by_branch", kpi.refunds_by_branch, "branches"),
    ("kpi02_monthly_levels", kpi.monthly_levels, "branches"),
):
    QUERIES[_name] = lambda spark, d, plan=_plan, dimension=_dimension: plan(star(spark, d).txn(dimension))


@query
def kpi03_product_share(spark, d):
    """Facts are summed by product version before they meet the products, so that sums hold no names."""
    s = star(spark, d)
    return kpi.product_share(kpi.point_in_time(kpi.by_product(s.facts), products=s.products))


@query
def kpi04_dormant_accounts(spark, d):
    s = star(spark, d)
    return kpi.dormant_accounts(s.facts, s.customers, s.products)


@query
def kpi01_from_daily_sums(spark, d):
    """K1 as a batch works it out, without the facts."""
    s = star(spark, d)
    return kpi.top_customers(kpi.by_customer(s.facts), s.customers)


for _name, _plan, _dimension in (
    ("kpi02_from_daily_sums", kpi.branch_monthly, "branches"), ("kpi03_from_daily_sums", kpi.product_share, "products"), ("kpi07_from_daily_sums", kpi.branch_ranking, "branches"), ("kpi09_from_daily_sums", kpi.refunds_by_product, "products"),
):
    QUERIES[_name] = lambda spark, d, plan=_plan, dimension=_dimension: plan(kpi.point_in_time(kpi.by_product_and_branch(star(spark, d).facts), **{dimension: getattr(star(spark, d), dimension)}))


@query
def kpi06_from_daily_sums(spark, d):
    s = star(spark, d)
    return kpi.segments(kpi.by_customer(s.facts), s.facts, s.customers)


@query
def json_file_state(spark, d):
    """Events' properties as sound arrays, arrays without commas, and arrays that are cut off: what is read, lost, and flagged of each."""
    e = table(spark, d, "events").withColumn("part", F.col("event_id") % 64)
    kind = F.col("part") % 3
    files = e.groupBy("event_type", "part").agg(F.collect_list("props").alias("props")).withColumn("props", F.array_sort("props"))
    text = F.concat(F.lit("["), F.array_join("props", ", "), F.when(kind == 2, ", {cut").otherwise("]"))
    bare = F.concat(F.lit("["), F.array_join("props", " "), F.lit("]"))
    return json_scan.state(files.select("event_type", "part", F.when(kind == 1, bare).otherwise(text).alias("value")), "value")


@query
def kpi05_suspicious_10min(spark, d):
    return kpi.suspicious(events(spark, d), high=300)


@query
def kpi05_suspicious_60min(spark, d):
    return kpi.suspicious(events(spark, d), minutes=60, high=300)


@query
def kpi06_customer_segments(spark, d):
    s = star(spark, d)
    return kpi.segments(s.txn(), s.facts, s.customers)


def _settled_lines(spark, d):
    """Line items as records of one file each batch: keys repeat, some fail a rule, some refer to nothing."""
    l = table(spark, d, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    rejects = F.array_compact(F.array(F.when(F.col("l_quantity") < 3, "LOW_QUANTITY"), F.when(F.col("l_discount") > 0.09, "HIGH_DISCOUNT"), F.when(F.col("l_partkey") % 97 == 0, "ORPHAN_PRODUCT")))
    flags = F.array_compact(F.array(F.when(F.col("l_tax") > 0.07, "NON_INR_CURRENCY"), F.when(F.col("l_returnflag") == "N", "MISSING_REFUND_FLAG")))
    disposition = F.when(F.size(rejects) > 0, dedupe.REJECTED).otherwise(dedupe.PASSED)
    return l.select(
        key.alias("record_key"), batch("l_orderkey", 20).alias("batch_id"), F.concat(F.col("l_linestatus"), F.lit(".csv")).alias("source_file"), rejects.alias(REJECTS), flags.alias(dedupe.COUNTED),
        disposition.alias(dedupe.DISPOSITION), F.to_json(F.struct("l_orderkey", "l_linenumber")).alias(readers.RAW),
    )


FILE = ("batch_id", "source_file")


@query
def kpi10_dq_scorecard(spark, d):
    lines = _settled_lines(spark, d)
    return kpi.dq_scorecard(dedupe.scorecard(lines, *FILE), dedupe.issue_counts(lines, *FILE))


@query
def issue_counts(spark, d):
    return dedupe.issue_counts(_settled_lines(spark, d), *FILE)


def _customer_versions(spark, d) -> tuple[DataFrame, DataFrame, list[str]]:
    """Day 1's dimension, and day 2's records: every seventh has another segment, every eleventh another name, some are new."""
    c = table(spark, d, "customer")
    base = c.select(keyed("C", "c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), keyed("A", "c_custkey").alias("account_id"), F.col("c_mktsegment").alias("kyc_status"), F.col("c_custkey").alias("k"))
    attributes = ["customer_name", "account_id", "kyc_status"]
    first = history.hashed(base.where("k % 13 <> 0"), attributes).drop("k")
    scd = {"valid_from": F.lit(history.FIRST), "valid_to": F.lit(history.OPEN), "is_current": F.lit(1), "batch_id": F.lit(BEFORE)}
    old = first.withColumns(scd).select("customer_id", *attributes, *history.SCD)
    moved = F.when(F.col("k") % 7 == 0, F.concat(F.lit("NEW "), "kyc_status")).otherwise(F.col("kyc_status"))
    named = F.when(F.col("k") % 11 == 0, F.concat("customer_name", F.lit(" II"))).otherwise(F.col("customer_name"))
    new = base.where("k % 3 <> 0").select("customer_id", named.alias("customer_name"), "account_id", moved.alias("kyc_status"))
    return old, new, attributes


def _merged(spark, d):
    old, new, _ = _customer_versions(spark, d)
    return history.merge_versions(old, new, "customer_id", ["kyc_status", "account_id"], AFTER, AFTER_DATE, [BEFORE, AFTER])


@query
def scd2_merge(spark, d):
    return _merged(spark, d)[0].drop("row_hash")


@query
def scd_actions(spark, d):
    return _merged(spark, d)[1]


@query
def scd1_update(spark, d):
    """Versions that were edited in place."""
    return _merged(spark, d)[0].where((F.col("batch_id") == AFTER) & (F.col("valid_from") == F.lit(history.FIRST)) & F.col("customer_name").endswith(" II")).select("customer_id", "customer_name", "kyc_status", "is_current")


@query
def scd_replay_protected(spark, d):
    """The earlier batch once more: what the later one changed is not undone."""
    old, new, attributes = _customer_versions(spark, d)
    merged, _ = history.merge_versions(old, new, "customer_id", ["kyc_status", "account_id"], AFTER, AFTER_DATE, [BEFORE, AFTER])
    again = old.select("customer_id", *attributes)
    return history.merge_versions(merged, again, "customer_id", ["kyc_status", "account_id"], BEFORE, dt.date(2026, 9, 30), [BEFORE, AFTER])[1]


@query
def kpi12_kyc_transitions(spark, d):
    return kpi.kyc_transitions(_merged(spark, d)[0])


@query
def asof_join(spark, d):
    """Orders with the customer's segment of the day: every fifth order is dated after the change."""
    versions = _merged(spark, d)[0]
    o = table(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 5 == 0, F.lit(AFTER_DATE)).otherwise(F.col("o_orderdate").cast("date"))
    orders = o.select("o_orderkey", keyed("A", "o_custkey").alias("account_id"), day.alias("day"))
    return history.as_of(orders, versions, "account_id", "account_id", "day", {"customer_id": "customer_id", "kyc_status": "kyc_status"}, "matches").withColumn("matches", F.col("matches").cast("long"))


FACT = ["account_id", "txn_date", "amount", "status", "remarks"]


def _fact_versions(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders as facts of day 1, and day 2's records: new orders, corrected amounts and statuses, repeats."""
    o = table(spark, d, "orders")
    base = o.select(
        F.col("o_orderkey").alias("transaction_id"), keyed("A", "o_custkey").alias("account_id"), F.col("o_orderdate").cast("date").alias("txn_date"), F.col("o_totalprice").cast("decimal(15,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).alias("remarks"), F.col("o_custkey").alias("customer_sk"),
    )
    old = history.hashed(base.where("transaction_id % 6 <> 0"), FACT).withColumns({"source_batch_id": F.lit(BEFORE), "last_updated_batch_id": F.lit(BEFORE)})
    amount = F.when(F.col("transaction_id") % 10 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(15,2)")
    status = F.when(F.col("transaction_id") % 15 == 0, "F").otherwise(F.col("status"))
    remarks = F.when(F.col("transaction_id") % 25 == 0, F.lit(None).cast("string")).otherwise(F.col("remarks"))
    new = base.where("transaction_id % 2 = 0 OR transaction_id % 15 = 0").withColumns({"amount": amount, "status": status, "remarks": remarks})
    return old, new


def _upserted(spark, d):
    old, new = _fact_versions(spark, d)
    return history.upsert_facts(old, new, "transaction_id", FACT, ["customer_sk"], AFTER, [BEFORE, AFTER])


@query
def fact_upsert(spark, d):
    return _upserted(spark, d)[0].drop("row_hash")


@query
def fact_actions(spark, d):
    return _upserted(spark, d)[1]


@query
def touched_days(spark, d):
    """The days of facts that day 2's records may change."""
    old, new = _fact_versions(spark, d)
    moved = new.where("transaction_id % 10 = 0").withColumn("txn_date", F.date_sub("txn_date", 1000))
    return history.touched_parts(old, moved, "transaction_id", F.date_format("txn_date", "yyyy-MM-dd"))


@query
def touched_days_by_key_index(spark, d):
    """The same, where facts are only read of days that the index of keys names."""
    old, new = _fact_versions(spark, d)
    moved = new.where("transaction_id % 10 = 0").withColumn("txn_date", F.date_sub("txn_date", 1000))
    day = F.date_format("txn_date", "yyyy-MM-dd")
    near = keys.may_hold(keys.summaries(old, "transaction_id", day), moved, "transaction_id")
    return history.touched_parts(old.join(near, day == F.col("held_in"), "left_semi"), moved, "transaction_id", day)


@query
def correction_diff(spark, d):
    """A row for each changed column of each corrected fact."""
    log = _upserted(spark, d)[2]
    keys = log.select("transaction_id", "old_values", "new_values", F.explode(F.map_keys("old_values")).alias("column_name"))
    return keys.select("transaction_id", "column_name", F.col("old_values")[F.col("column_name")].alias("old_value"), F.col("new_values")[F.col("column_name")].alias("new_value"))


@query
def kpi11_incremental_counts(spark, d):
    s = star(spark, d)
    log = _upserted(spark, d)[2]
    dims = {"customers": s.customers, "products": s.products, "branches": s.branches}
    return kpi.incremental_counts(s.facts, log, dims, AFTER, AFTER_DATE)


@query
def kpi_snapshot(spark, d):
    s = star(spark, d)
    txn = s.txn("branches")
    return kpi.snapshot(txn, txn, s.customers, AFTER)


@query
def kpi11_kpi_deltas(spark, d):
    s = star(spark, d)
    txn = s.txn("branches")
    older = txn.where(F.col("source_batch_id") == BEFORE)
    before = kpi.snapshot(older, older, s.customers, BEFORE)
    return kpi.snapshot_deltas(before.unionByName(kpi.snapshot(txn, txn, s.customers, AFTER)), BEFORE, AFTER)


@query
def kpi13_new_activations(spark, d):
    return kpi.new_activations(facts(spark, d), customers(spark, d), AFTER)


@query
def range_self_join(spark, d):
    """Events that at least three of the same user's in the hour up to them, by a join on time ranges.

    The join is on user and hour, an earlier event standing in its own hour and the next, so a
    user of very many events is spread over hours.
    """
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.date_trunc("hour", "ts").alias("hour"))
    both = F.explode(F.array("hour", F.col("hour") + F.expr("INTERVAL 1 HOUR")))
    earlier = e.select("user_id", F.col("ts").alias("earlier"), both.alias("hour"))
    near = e.join(earlier, ["user_id", "hour"]).where("earlier BETWEEN ts - INTERVAL 60 MINUTES AND ts")
    return near.groupBy("event_id").agg(F.count("*").alias("n")).where("n >= 3")


def _ordered_lines(spark, d):
    l = table(spark, d, "lineitem")
    order = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
    return l.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), "l_partkey", "l_suppkey", "l_quantity", order.alias("o"), F.col("l_tax"), "l_returnflag", "l_discount")


def _raw_customers(spark, d):
    """A customers' file: ids that two rows have, blank ones, unknown codes, missing addresses, shared accounts, repeated lines."""
    k = F.col("c_custkey")
    key = F.when(k % 10 == 1, k - 1).otherwise(k)
    values = {
        "customer_id": F.when(k % 17 == 0, "  ").otherwise(F.concat(F.lit(" C"), key.cast("string"))),
        "customer_name": F.col("c_name"),
        "email": F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("X"), k.cast("string"), F.lit("@Mail.org "))),
        "phone": F.lit("98765 43210"),
        "account_id": F.when(k % 23 == 0, "").otherwise(F.concat(F.lit("a"), (key % 700).cast("string"))),
        "gender": F.lit("m"),
        "dob": F.lit("1990-01-31"),
        "address": F.lit("1 x st"),
        "kyc_status": F.when(k % 7 == 3, "none").when(k % 2 == 0, "VERIFIED").otherwise(" pending"),
        "registration_date": F.concat(F.lit("2020-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")),
        "transaction_id": F.lit(""),
    }
    rows = table(spark, d, "customer").select(*[v.alias(c) for c, v in values.items()], k.alias("k"))
    whole = rows.withColumn(readers.POSITION, F.explode(F.when(F.col("k") % 50 == 0, F.array("k", F.col("k") + 10_000_000)).otherwise(F.array("k"))))
    return whole.select(*values, readers.POSITION, F.to_json(F.struct("k", *values)).alias(readers.RAW), F.lit(None).cast("string").alias(readers.LOST))


def _settled(rows, entity, day, **values) -> DataFrame:
    """Every record's disposition, reasons and counted flags, and what is clean of those that pass. values: name -> clean column."""
    settled = dedupe.settle(rows, ENTITIES[entity], day)
    passed = [F.when(F.col(dedupe.DISPOSITION) == dedupe.PASSED, v).alias(n) for n, v in values.items()]
    return settled.select(F.col(readers.POSITION).alias("pos"), "record_key", F.col(dedupe.DISPOSITION).alias("disposition"), F.array_join(REJECTS, ";").alias("reasons"), F.array_join(dedupe.COUNTED, ";").alias("flags"), *passed)


def _file(rows: DataFrame, k: str, values: dict) -> DataFrame:
    """Rows of a table as text records, which say their number; every fiftieth stands there twice."""
    said = rows.select(F.col(k).cast("long").alias("_k"), *[v.cast("string").alias(c) for c, v in values.items()])
    places = F.when(F.col("_k") % 50 == 0, F.array("_k", F.col("_k") + 1_000_000_000_000)).otherwise(F.array("_k"))
    return said.select(*values, F.explode(places).alias(readers.POSITION), F.to_json(F.struct("_k", *values)).alias(readers.RAW), F.lit(None).cast("string").alias(readers.LOST))


def _id(letter: str, k):
    """An id that two numbers share, with blanks around it, or a blank."""
    return F.when(k % 17 == 0, "  ").otherwise(F.concat(F.lit(f" {letter}"), F.when(k % 10 == 1, k - 1).otherwise(k).cast("string")))


@query
def settle_customers(spark, d):
    names = ("customer_id", "email", "phone", "account_id", "address", "kyc_status", "registration_date")
    return _settled(_raw_customers(spark, d), "customers", dt.date(2026, 9, 30), **{c: F.col(f"clean.{c}") for c in names})


@query
def settle_products(spark, d):
    k = F.col("p_partkey").cast("long")
    rows = _file(table(spark, d, "part"), "p_partkey", {
        "product_id": _id("P", k), "product_name": F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("name  "), k.cast("string"))),
        "product_type": F.when(k % 13 == 0, "?").when(k % 2 == 0, "LOAN ").otherwise(" savings  Account"),
        "price": F.when(k % 19 == 0, "x").when(k % 8 == 0, F.concat(F.lit("-"), k.cast("string"), F.lit(".50"))).otherwise(F.concat(F.lit("Rs. 1,"), F.lpad((k % 1000).cast("string"), 3, "0"))),
        "launch_date": F.lit("2020/1/31"), "is_active": F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "false").otherwise("yes"), "category": F.when(k % 11 == 0, "gold").otherwise(" sme"), "vendor_name": F.when(k % 4 == 0, " ").otherwise("v"),
    })
    clean = {c: F.col(f"clean.{c}") for c in ("product_name", "product_type", "launch_date", "vendor_name")}
    return _settled(rows, "products", dt.date(2026, 9, 30), **clean, price=F.col("clean.price").cast("double"), is_active=F.col("clean.is_active").cast("long"))


@query
def settle_branches(spark, d):
    k = F.col("s_suppkey").cast("long")
    rows = _file(table(spark, d, "supplier"), "s_suppkey", {
        "branch_id": _id("B", k), "branch_name": F.concat(F.lit(" branch "), k.cast("string")), "location": F.lit("new DELHI-o'neil"), "manager_name": F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("m"), k.cast("string"))),
        "opened_date": F.when(k % 3 == 0, "07-08-2022").otherwise("2022-08-07"), "region": F.when(k % 7 == 3, "centre").otherwise("SOUTH "), "branch_type": F.when(k % 9 == 0, "").otherwise("rural"),
        "contact_number": F.when(k % 6 == 0, "1").otherwise("+91 98765 43210"),
    })
    return _settled(rows, "branches", dt.date(2026, 9, 30), **{c: F.col(f"clean.{c}") for c in ("branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number")})


@query
def settle_transactions(spark, d):
    """Orders as records before all of a year is over: some ids twice, with other values; blank ids, bad codes, times and amounts."""
    k, ordered = F.col("o_orderkey").cast("long"), F.col("o_orderdate").cast("date")
    day, other_day = F.date_format(ordered, "yyyy-MM-dd"), F.date_format(F.date_sub(ordered, 1), "yyyy-MM-dd")
    rows = _file(table(spark, d, "orders"), "o_orderkey", {
        "transaction_id": _id("T", k), "account_id": F.when(k % 23 == 0, "").otherwise(F.concat(F.lit(" a"), F.col("o_custkey").cast("string"))), "product_id": F.lit("p1"), "branch_id": F.lit("b1"),
        "date": F.when(k % 4 == 0, other_day).otherwise(day), "timestamp": F.when(k % 29 == 0, "x").otherwise(F.concat(day, F.lit(" 10:00:00"))),
        "amount": F.when(k % 44 == 0, "").when(k % 44 == 1, "-5").when(k % 44 == 2, "0").when(k % 44 == 3, "zz").otherwise(F.concat(F.lit("₹ "), F.format_number(F.lit(1000.5) + k % 1000, 1))),
        "payment_method": F.when(k % 19 == 0, "").otherwise(" upi"), "status": F.when(k % 31 == 0, "?").when(k % 2 == 0, "FAILD").otherwise("Succes "),
        "currency": F.when(k % 37 == 0, "rupee").when(k % 13 == 0, "usd").otherwise("inr"), "remarks": F.when(k % 3 == 0, "[late correction] ").otherwise(F.concat(F.lit("note  "), k.cast("string"), F.lit(" [late correction]"))),
        "is_refund": F.when(k % 41 == 0, "q").when(k % 5 == 0, "").when(k % 2 == 0, "Y").otherwise("0"),
    })
    clean = {c: F.col(f"clean.{c}") for c in ("account_id", "txn_date", "currency", "payment_method", "status", "remarks")}
    return _settled(
        rows, "transactions", dt.date(1998, 1, 1), **clean, **{c: F.col(f"clean.{c}").cast("double") for c in ("amount", "amount_inr")}, **{c: F.col(f"clean.{c}").cast("long") for c in ("is_refund", "date_mismatch", "needs_review")}
    )


@query
def exact_dedupe(spark, d):
    """Documents by their text: the first copy, and how many repeat it."""
    marked = dedupe.mark_exact_duplicates(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id")
    return marked.select("doc_id", F.col("_copy").cast("long").alias("copy"), (F.col("_copy") > 1).alias("duplicate"))


@query
def conflict_quarantine(spark, d):
    """Lines whose key another line has."""
    return dedupe.mark_conflicts(_ordered_lines(spark, d), "key").where("_conflict").select("key", "l_partkey", "l_suppkey", "l_quantity")


@query
def best_copy(spark, d):
    """Of the lines of a key the one with the fewest flags, the last in order of equal ones."""
    lines = _ordered_lines(spark, d)
    flags = F.array_compact(F.array(F.when(F.col("l_tax") > 0.04, "TAXED"), F.when(F.col("l_returnflag") == "N", "MISSING_REFUND_FLAG"), F.when(F.col("l_discount") > 0.05, "DISCOUNTED")))
    best = dedupe.mark_best_copy(lines.withColumn("flags", flags), "key", "flags", "o").where("_rank = 1")
    return best.select("key", "l_partkey", "l_suppkey", F.size("flags").cast("long").alias("n_flags"))


@query
def account_owner(spark, d):
    """The customer of each part of a street who ordered first."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("first_order"))
    c = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select((F.col("c_custkey") % 500).alias("account"), F.col("c_custkey").alias("customer"), "first_order")
    return dedupe.mark_owner(c, "account", "first_order", "customer").select("account", "customer", F.col("_owner").alias("is_owner"))


@query
def referential_check(spark, d):
    """Reasons of lines whose part or supplier is not among the known ones."""
    l = table(spark, d, "lineitem")
    settled = l.select("l_orderkey", "l_linenumber", F.struct("l_partkey", "l_suppkey").alias("clean"), F.array().cast("array<string>").alias("_rejects"), F.lit(dedupe.PASSED).alias("_disposition"))
    known = {"ORPHAN_PRODUCT": ("l_partkey", table(spark, d, "part").where("p_size < 45").select("p_partkey")), "ORPHAN_BRANCH": ("l_suppkey", table(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey"))}
    judged = dedupe.check_references(settled, known).where(F.size("_rejects") > 0)
    return judged.select("l_orderkey", "l_linenumber", F.col("clean.l_partkey").alias("l_partkey"), F.array_join("_rejects", ";").alias("reasons"))


def _messy(spark, d):
    """Customers' numbers and names written in many ways."""
    c = table(spark, d, "customer")
    n = F.col("c_custkey").cast("string")
    return c.select(
        "c_custkey",
        F.concat(pick(("  ", "Rs.", "₹ ", "INR ", "rs "), "c_custkey"), pick(("", "-", "1,"), "c_custkey"), n, pick((".125", ".5", "", ".375", "x", "e2"), "c_custkey")).alias("amount"),
        F.concat(pick(("01/02/", "13-02-", "2020/1/", "31/04/", "2021-12-", "x"), "c_custkey"), pick(("2001", "7", "31", "1999"), "c_custkey")).alias("day"),
        F.concat(pick((" Succes", "FAILD ", "pending", "Sucess", "none", ""), "c_custkey"), pick(("", " ", "\t"), "c_custkey")).alias("status"),
        F.concat(pick(("  Main", "park", "5th"), "c_custkey"), pick((" ave-", "  o'neil ", "  "), "c_custkey"), F.lower("c_name")).alias("address"),
        F.concat(pick(("A.b", "x y", ""), "c_custkey"), pick(("@Mail.org", "@mail", "mail.org"), "c_custkey")).alias("email"),
        F.concat(pick(("+91 ", "91", "", "0"), "c_custkey"), F.lpad(n, 10, "7"), pick(("", "-", "1"), "c_custkey")).alias("phone"),
    )


@query
def parse_amount(spark, d):
    return _messy(spark, d).select("c_custkey", tx.parse_amount(F.col("amount")).alias("amount"))


@query
def date_candidates(spark, d):
    m, c = _messy(spark, d), tx.date_candidates(F.col("day"))
    return m.select("c_custkey", tx.parse_date(F.col("day")).alias("first"), F.get(c, 1).alias("second"), F.size(c).cast("long").alias("readings"))


@query
def lookup_codes(spark, d):
    return _messy(spark, d).select("c_custkey", tx.lookup(F.col("status"), codes.STATUS).alias("status"))


@query
def clean_text(spark, d):
    return _messy(spark, d).select("c_custkey", tx.clean_text(F.col("address")).alias("address"))


@query
def title_case(spark, d):
    return _messy(spark, d).select("c_custkey", tx.title_case(F.col("address")).alias("address"))


@query
def email_phone(spark, d):
    m, e, p = _messy(spark, d), tx.clean_email(F.col("email")), tx.clean_phone(F.col("phone"))
    return m.select("c_custkey", e.value.alias("email"), F.coalesce(e.valid, F.lit(False)).alias("email_valid"), p.value.alias("phone"), p.valid.alias("phone_valid"))


@query
def shape_profile(spark, d):
    return serving.profile(table(spark, d, "events").select("event_type", "props"), 5)


@query
def duplicate_profile(spark, d):
    return serving.duplicates(table(spark, d, "documents").select("text", "lang", "source"), "text")


@query
def branch_trend(spark, d):
    """The monthly trend of one branch, in order."""
    return serving.listing(QUERIES["kpi02_branch_monthly"](spark, d).where("branch_id = 'B7'"), "month_start")


@query
def at_risk_exposure(spark, d):
    return serving.at_risk(QUERIES["kpi08_kyc_exposure"](spark, d))


@query
def dormant_listing(spark, d):
    """Dormant accounts as a report lists them, with their place."""
    return serving.placed(kpi04_dormant_accounts(spark, d), "dormancy_class DESC NULLS LAST", "days_inactive DESC NULLS LAST", "account_id").select("account_id", "dormancy_class", "days_inactive", "place")


@query
def value_listing(spark, d):
    """The values of columns that have few."""
    return serving.value_listing(table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey"))


@query
def repeated_keys(spark, d):
    return serving.repeated_keys(_ordered_lines(spark, d).select("key"), "key")


@query
def row_hashes(spark, d):
    """SHA-256 of customers' standardised rows; null and '' differ."""
    c = table(spark, d, "customer").select("c_custkey", F.nullif(F.substring("c_name", -1, 1), F.lit("3")).alias("last"), F.col("c_nationkey").alias("nation"))
    return history.hashed(c, ["last", "nation"]).select("c_custkey", "row_hash")


@query
def parse_flags(spark, d):
    """Booleans, remarks without the mark of a correction, and blanks as null."""
    c = table(spark, d, "customer")
    said = F.concat(pick(("", " "), "c_custkey"), pick(("yes", "TRUE", "n", "False", "1", "maybe", ""), "c_custkey"))
    remark = F.concat(pick(("paid", " ", "late "), "c_custkey"), pick((" [late correction]", "", "  twice"), "c_nationkey"))
    return c.select("c_custkey", tx.parse_bool(said).cast("boolean").alias("said"), tx.clean_remarks(remark).alias("remarks"), tx.blank_to_null(tx.clean_text(pick(("", " ", "x"), "c_custkey"))).alias("blank"))


@query
def parse_timestamp(spark, d):
    c = table(spark, d, "customer")
    text = F.concat(pick(("2020-1-5", "2021-02-30", "2019-12-31", " 2020-02-29", "5/6/2020"), "c_custkey"), pick((" 1:2:3", " 23:59:59", "  00:00:00 ", " 24:00:00", ""), "c_nationkey"))
    return c.select("c_custkey", tx.parse_timestamp(text).alias("at"))


@query
def file_metadata(spark, d):
    return readers.file_metadata(spark, f"{d}/region.parquet")


@query
def pivot_month_region(spark, d):
    return serving.pivot(kpi.valued(star(spark, d).txn("branches")), "month_start", "region", "net_inr", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@query
def pivot_quarter_product(spark, d):
    return serving.pivot(kpi.valued(star(spark, d).txn("products")), "quarter", "product_type", "net_inr", ["Credit Card", "Fixed Deposit", "Loan", "Savings Account"])


@query
def dashboard_totals(spark, d):
    return serving.totals(star(spark, d).txn(), dedupe.scorecard(_settled_lines(spark, d), *FILE))


@query
def segment_counts(spark, d):
    return serving.counts_by(kpi06_customer_segments(spark, d), "segment")


@query
def reason_counts(spark, d):
    return serving.reason_counts(kpi05_suspicious_60min(spark, d), "risk_reason", ["HIGH_VALUE", "VELOCITY_3_IN_60_MIN", "ODD_HOURS"])


@query
def reason_filter(spark, d):
    return serving.any_reason(kpi05_suspicious_60min(spark, d), "risk_reason", ["HIGH_VALUE", "VELOCITY_3_IN_60_MIN"]).select("transaction_id", "risk_reason")


@query
def quarantine_search(spark, d):
    rejected = dedupe.quarantine(_settled_lines(spark, d)).select(F.col("record_key").alias("key"), F.col("reason_codes").alias("reasons"))
    return serving.search(rejected, "orphan", ["key", "reasons"])


@query
def safe_csv(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(pick(("=", "+", "-", "@", ""), "c_custkey"), F.col("c_name")).alias("c_name"))
    return serving.safe_csv(c)


@query
def json_salvage(spark, d):
    """Events' properties written as one broken array for each type: every object is recovered."""
    e = table(spark, d, "events")
    files = e.groupBy("event_type", (F.col("event_id") % 64).alias("part")).agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("props")), " "), F.lit(" {cut")).alias("value"))
    rows = json_scan.salvage_texts(files)
    return rows.groupBy(F.col("_raw").alias("record"), F.col("_lost").alias("fragment")).agg(F.count("*").alias("n"))


def _plain(f: Query) -> Query:
    """Money as double in the result: sums are exact decimals before, and both engines convert alike."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if kind.startswith("decimal") else F.col(f"`{c}`") for c, kind in df.dtypes])

    return run


def queries() -> dict[str, Query]:
    return {name: _plain(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
