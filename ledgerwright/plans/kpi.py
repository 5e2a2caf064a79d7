"""The business metrics, as plans over the fact table with its point-in-time attributes.

Money metrics are over `valued` transactions: successful ones with a rupee amount, refunds
subtracted. Every ranking that cuts ends in a key, so results don't depend on the order of rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MONEY = "decimal(18,2)"
HIGH_VALUE = 100_000
BURST, BURST_MINUTES = 3, 10
ODD_BEFORE = 5
#: A slice of an account's time, in windows of a burst, and ranges that a numbering is cut into at most.
SLICE_WINDOWS, RANGES = 6, 64
DORMANT_DAYS = 90
RISKY_PRODUCTS = ("Credit Card", "Loan")


def percent(part: Column, whole: Column, places: int) -> Column:
    """100 * part / whole as a rounded double; null where the whole is zero."""
    return F.round(F.try_divide(100 * part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))), places)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def point_in_time(facts: DataFrame, customers: DataFrame | None = None, products: DataFrame | None = None, branches: DataFrame | None = None) -> DataFrame:
    """The facts with the attributes of the dimension versions they point to, and their net value.

    Facts point to a version of every dimension (a batch that would break this is not published),
    so a metric names only the dimensions whose attributes it uses and the others aren't joined.
    Partial sums of facts (by_customer, by_product, by_product_and_branch) do instead of facts.
    """
    joined = facts
    if customers is not None:
        joined = joined.join(customers.select("customer_sk", "customer_name", "kyc_status"), "customer_sk")
    if products is not None:
        joined = joined.join(products.select("product_sk", "product_name", "product_type", "category"), "product_sk")
    if branches is not None:
        joined = joined.join(branches.select("branch_sk", "branch_name", "region"), "branch_sk")
    quarter = F.concat(F.year("txn_date").cast("string"), F.lit("-Q"), F.quarter("txn_date").cast("string"))
    net = F.when(F.col("is_refund") == 1, -F.col("amount_inr")).otherwise(F.col("amount_inr"))
    periods = {"month_start": F.trunc("txn_date", "MM"), "quarter": quarter} if "txn_date" in facts.columns else {}
    return joined.withColumns(periods if is_partial(facts) else periods | {"net_inr": net})


def valued(txn: DataFrame) -> DataFrame:
    return txn.where("status = 'Success' AND amount_inr IS NOT NULL")


def is_partial(df: DataFrame) -> bool:
    """Whether rows are sums over transactions rather than transactions."""
    return "txn_count" in df.columns


def _sums() -> list[Column]:
    refunded = F.when(F.col("is_refund") == 1, F.col("amount_inr")).otherwise(F.lit(0).cast("decimal(15,2)"))
    return [
        F.count("*").alias("txn_count"), money(F.sum("net_inr")).alias("net_value_inr"), F.sum(F.col("is_refund").cast("long")).alias("refund_count"),
        money(F.sum(refunded)).alias("refund_value_inr"), money(F.sum("amount_inr")).alias("gross_inr"),
    ]


def by_customer(facts: DataFrame) -> DataFrame:
    """Partial sums by day and customer: what K1 and K6 add up."""
    return valued(point_in_time(facts)).groupBy("txn_date", "customer_id").agg(*_sums()[:2])


def by_product_and_branch(facts: DataFrame) -> DataFrame:
    """Partial sums by day, product and branch version: what K2, K3, K7 and K9 add up."""
    return valued(point_in_time(facts)).groupBy("txn_date", "product_id", "product_sk", "branch_id", "branch_sk").agg(*_sums())


def by_product(facts: DataFrame) -> DataFrame:
    """Partial sums by product version: what K3b adds up."""
    return valued(point_in_time(facts)).groupBy("product_id", "product_sk").agg(*_sums()[:2])


def _totals(txn: DataFrame, *keys: str) -> DataFrame:
    if is_partial(txn):
        return txn.groupBy(*keys).agg(F.sum("txn_count").alias("txn_count"), money(F.sum("net_value_inr")).alias("net_value_inr"))
    return valued(txn).groupBy(*keys).agg(F.count("*").alias("txn_count"), money(F.sum("net_inr")).alias("net_value_inr"))


def top_customers(txn: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    """K1: the customers of greatest net value (then of more transactions), with current attributes.

    Ranks count every current customer. Only those in the first k rows by (value, count, id) are
    sorted; equal ones share a rank, which is that of the first of them.
    """
    totals = _totals(txn, "customer_id").join(customers.where("is_current = 1").select("customer_id", "customer_name", "account_id"), "customer_id")
    top = totals.orderBy(F.desc("net_value_inr"), F.desc("txn_count"), "customer_id").limit(k)
    rank = F.rank().over(Window.orderBy(F.desc("net_value_inr"), F.desc("txn_count")))
    return top.select(rank.cast("long").alias("rank_no"), "customer_id", "customer_name", "account_id", "net_value_inr", "txn_count")


def _growth(totals: DataFrame, window, places: int = 1) -> tuple[Column, Column]:
    before = F.lag("net_value_inr").over(window)
    return before, percent(F.col("net_value_inr") - before, before, places)


def branch_monthly(txn: DataFrame) -> DataFrame:
    """K2a: by branch and month, with growth over the branch's previous month of activity."""
    totals = _totals(txn, "region", "branch_id", "branch_name", "month_start")
    before, growth = _growth(totals, Window.partitionBy("branch_id").orderBy("month_start", "region", "branch_name"))
    return totals.select("region", "branch_id", "branch_name", "month_start", "txn_count", "net_value_inr", before.alias("prev_month_value_inr"), growth.alias("mom_growth_pct"))


def region_monthly(txn: DataFrame) -> DataFrame:
    """K2b: the same by region."""
    totals = _totals(txn, "region", "month_start")
    _, growth = _growth(totals, Window.partitionBy("region").orderBy("month_start"))
    return totals.select("region", "month_start", "txn_count", "net_value_inr", growth.alias("mom_growth_pct"))


def monthly_levels(txn: DataFrame) -> DataFrame:
    """K2a and K2b from one pass: `level` is branch or region, and a region's rows have no branch."""
    many, net = (F.sum("txn_count"), F.sum("net_value_inr")) if is_partial(txn) else (F.count("*"), F.sum("net_inr"))
    keys = ["region", "branch_id", "branch_name", "month_start"]
    rows = txn if is_partial(txn) else valued(txn)
    totals = rows.groupingSets([keys, ["region", "month_start"]], *keys).agg(F.grouping("branch_id").alias("whole"), many.alias("txn_count"), money(net).alias("net_value_inr"))
    level = F.when(F.col("whole") == 1, "region").otherwise("branch")
    # a branch that moved keeps its own series, as in K2a
    series = Window.partitionBy("whole", "branch_id", F.when(F.col("whole") == 1, F.col("region"))).orderBy("month_start", "region", "branch_name")
    before, growth = _growth(totals, series)
    return totals.select(level.alias("level"), *keys, "txn_count", "net_value_inr", before.alias("prev_month_value_inr"), growth.alias("mom_growth_pct"))


def product_revenue(txn: DataFrame) -> DataFrame:
    """K3a: revenue of product types by quarter: share of the quarter, growth over the previous one."""
    totals = _totals(txn, "quarter", "product_type")
    before, growth = _growth(totals, Window.partitionBy("product_type").orderBy("quarter"))
    whole = F.sum("net_value_inr").over(Window.partitionBy("quarter"))
    return totals.select(
        "quarter", "product_type", F.col("net_value_inr").alias("revenue_inr"), "txn_count", percent(F.col("net_value_inr"), whole, 1).alias("share_of_quarter_pct"),
        before.alias("prev_quarter_revenue_inr"), growth.alias("qoq_growth_pct"),
    )


def product_share(txn: DataFrame) -> DataFrame:
    """K3b: each product's share of all revenue; the total is one row, joined, so no task holds all products."""
    totals = _totals(txn, "product_id", "product_name", "product_type", "category")
    whole = _totals(txn).select(F.col("net_value_inr").alias("whole"))
    return totals.crossJoin(F.broadcast(whole)).select(
        "product_id", "product_name", "product_type", "category", F.col("net_value_inr").alias("revenue_inr"), percent(F.col("net_value_inr"), F.col("whole"), 2).alias("share_pct")
    )


def dormant_accounts(facts: DataFrame, customers: DataFrame, products: DataFrame, days: int = DORMANT_DAYS) -> DataFrame:
    """K4: current customers without a transaction in the days before the latest one, or ever."""
    as_of = facts.agg(F.max("txn_date").alias("as_of_date"))
    last = facts.groupBy("account_id").agg(F.max_by(F.struct("txn_date", "product_id"), F.struct("txn_ts", "transaction_id", "product_id")).alias("last")).select("account_id", "last.txn_date", "last.product_id")
    kinds = products.where("is_current = 1").select("product_id", "product_type")
    joined = customers.where("is_current = 1").crossJoin(F.broadcast(as_of)).join(last, "account_id", "left").join(kinds, "product_id", "left")
    idle = joined.where(F.col("txn_date").isNull() | (F.col("txn_date") < F.date_sub("as_of_date", days)))
    risk = F.when(F.col("product_type").isin(*RISKY_PRODUCTS), "High-risk dormant").otherwise("Dormant")
    inactive = F.datediff("as_of_date", "txn_date").cast("long")
    return idle.select("account_id", "customer_id", "customer_name", F.col("txn_date").alias("last_txn_date"), inactive.alias("days_inactive"), "product_type", risk.alias("dormancy_class"))


def with_burst(txn: DataFrame, name: str, minutes: int = BURST_MINUTES) -> DataFrame:
    """txn with the account's transactions in the minutes up to each (equal times included).

    An account's time is cut into slices of some windows' length, so that one of very many
    transactions is many tasks. What lies within a window of a slice's end is also in the next one, where it is
    counted but not returned.
    """
    window, length = 60 * minutes, 60 * minutes * SLICE_WINDOWS
    second = F.unix_date(F.to_date("txn_ts")).cast("long") * 86_400 + F.hour("txn_ts") * 3600 + F.minute("txn_ts") * 60 + F.second("txn_ts").cast("int")
    own = F.floor(second / F.lit(length))
    late = second - own * length >= length - window
    sliced = txn.withColumn("_own", own).withColumn("_slice", F.explode(F.when(late, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))))
    count = F.expr(f"count(1) OVER (PARTITION BY account_id, _slice ORDER BY txn_ts RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW)")
    return sliced.withColumn(name, count).where("_slice <=> _own").drop("_slice", "_own")


def suspicious(txn: DataFrame, minutes: int = BURST_MINUTES, burst: int = BURST, high: int = HIGH_VALUE) -> DataFrame:
    """K5: transactions of any status of high value, in a burst, or at odd hours, with the reasons."""
    near = f"txns_in_{minutes}_min"
    large, fast, odd = F.col("amount_inr") > high, F.col(near) >= burst, F.hour("txn_ts") < ODD_BEFORE
    named = ((large, "HIGH_VALUE"), (fast, f"VELOCITY_{burst}_IN_{minutes}_MIN"), (odd, "ODD_HOURS"))
    reason = F.concat_ws(" | ", *[F.when(c, n) for c, n in named])
    found = with_burst(txn, near, minutes).where(large | fast | odd)
    return found.select("transaction_id", "account_id", "customer_id", "customer_name", "txn_ts", "amount", "currency", "status", F.col(near).cast("long").alias(near), reason.alias("risk_reason"))


def tiles(scores: DataFrame, values: list[tuple[str, bool, str]], n: int = 3) -> DataFrame:
    """scores with a tile from 1 to n for each (value, descending, name), equal values in order of customer_id.

    No task sorts all rows: some rows, chosen by a hash of their key, are the edges of ranges of (value, key), one
    pass counts the rows of all ranges, and rows are numbered inside their range from its first
    number on. As the key is part of an edge, very many rows of one value are several ranges too.
    There are at most RANGES, so edges and counts are one short row, broadcast.
    """
    ranges = min(RANGES, max(2, int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    place = [F.struct((-F.col(v) if descending else F.col(v)).alias("v"), "customer_id") for v, descending, _ in values]
    some = scores.orderBy(F.xxhash64("customer_id"), "customer_id").limit(ranges - 1)
    placed = scores.crossJoin(F.broadcast(some.agg(*[F.sort_array(F.collect_list(p)).alias(f"_edges{k}") for k, p in enumerate(place)])))
    for k, p in enumerate(place):
        placed = placed.withColumn("_place", p).withColumn(f"_range{k}", F.expr(f"size(filter(_edges{k}, e -> e < _place))"))
    placed = placed.drop("_place", *[f"_edges{k}" for k in range(len(values))])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_range{k}").alias("r")) for k in range(len(values))]))
    counts = placed.select(each.alias("x")).groupBy("x.k", "x.r").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("k", "r", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("k")).alias("all"))
    maps = [F.map_from_entries(F.collect_list(F.when(F.col("k") == k, F.struct("r", "before")))).alias(f"_starts{k}") for k in range(len(values))]
    numbered = placed.crossJoin(F.broadcast(starts.agg(F.max("all").alias("_all"), *maps)))
    whole, more = F.floor(F.col("_all") / n), F.col("_all") % n
    edge = more * (whole + 1)
    for k, (value, descending, name) in enumerate(values):
        order = F.desc(value) if descending else F.asc(value)
        row = F.row_number().over(Window.partitionBy(f"_range{k}").orderBy(order, "customer_id"))
        numbered = numbered.withColumn("_number", row + F.element_at(f"_starts{k}", F.col(f"_range{k}")))
        tile = F.when(F.col("_number") <= edge, F.ceil(F.col("_number") / (whole + 1))).otherwise(more + F.ceil(F.try_divide(F.col("_number") - edge, whole)))
        numbered = numbered.withColumn(name, tile.cast("long"))
    return numbered.select(*scores.columns, *[name for *_, name in values])


def segments(txn: DataFrame, facts: DataFrame, customers: DataFrame) -> DataFrame:
    """K6: tiers by recency, frequency and monetary thirds."""
    as_of = facts.agg(F.max("txn_date").alias("as_of_date"))
    several = (txn, F.sum("txn_count"), "net_value_inr") if is_partial(txn) else (valued(txn), F.count("*"), "net_inr")
    scores = several[0].groupBy("customer_id").agg(F.max("txn_date").alias("last"), several[1].alias("frequency"), money(F.sum(several[2])).alias("monetary_inr"))
    scores = scores.crossJoin(F.broadcast(as_of)).select("customer_id", F.datediff("as_of_date", "last").cast("long").alias("recency_days"), "frequency", "monetary_inr")
    scores = tiles(scores, [("recency_days", True, "r_score"), ("frequency", False, "f_score"), ("monetary_inr", False, "m_score")])
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    tier = F.when(total >= 8, "Platinum").when(total >= 6, "Gold").when(total >= 4, "Silver").otherwise("Bronze")
    named = scores.join(customers.where("is_current = 1").select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", "recency_days", "frequency", "monetary_inr", "r_score", "f_score", "m_score", total.alias("rfm_total"), tier.alias("segment"))


def branch_ranking(txn: DataFrame) -> DataFrame:
    """K7: branches by revenue within their region, from both ends."""
    totals = _totals(txn, "region", "branch_id", "branch_name")
    down = Window.partitionBy("region").orderBy(F.desc("net_value_inr"))
    up = Window.partitionBy("region").orderBy(F.asc("net_value_inr"))
    ranked = totals.withColumns({"rank_in_region": F.rank().over(down).cast("long"), "dense_rank_in_region": F.dense_rank().over(down).cast("long"), "_up": F.rank().over(up)})
    performer = F.when(F.col("rank_in_region") == 1, "Top performer").when(F.col("_up") == 1, "Bottom performer")
    return ranked.select("region", "branch_id", "branch_name", F.col("net_value_inr").alias("revenue_inr"), "txn_count", "rank_in_region", "dense_rank_in_region", performer.alias("performer"))


def kyc_exposure(txn: DataFrame) -> DataFrame:
    """K8: by the customer's KYC status at the time of the transaction."""
    everything = Window.partitionBy(F.lit(1))  # a row for each status
    totals = _totals(txn, "kyc_status")
    return totals.select(
        "kyc_status", "txn_count", F.col("net_value_inr").alias("value_inr"), percent(F.col("txn_count"), F.sum("txn_count").over(everything), 1).alias("share_of_count_pct"),
        percent(F.col("net_value_inr"), F.sum("net_value_inr").over(everything), 1).alias("share_of_value_pct"), (F.col("kyc_status") != "Verified").alias("at_risk"),
    )


def _refunds(txn: DataFrame, *keys: str) -> DataFrame:
    if is_partial(txn):
        sums = txn.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("txn_count", "refund_count")], *[money(F.sum(c)).alias(c) for c in ("refund_value_inr", "gross_inr")])
    else:
        sums = valued(txn).groupBy(*keys).agg(*_sums()).drop("net_value_inr")
    return sums.withColumn("refund_rate_pct", percent(F.col("refund_count"), F.col("txn_count"), 1)).withColumn("refund_value_pct", percent(F.col("refund_value_inr"), F.col("gross_inr"), 1))


def refunds_by_product(txn: DataFrame) -> DataFrame:
    """K9a."""
    return _refunds(txn, "product_type").drop("gross_inr")


def refunds_by_branch(txn: DataFrame) -> DataFrame:
    """K9b."""
    return _refunds(txn, "region", "branch_id", "branch_name").drop("gross_inr", "refund_value_pct")


def dq_scorecard(scorecard: DataFrame, issues: DataFrame, k: int = 3) -> DataFrame:
    """K10: each file's counts, its pass rate, and the k commonest reasons to reject."""
    rank = F.row_number().over(Window.partitionBy("batch_id", "source_file").orderBy(F.desc("record_count"), "reason_code"))
    top = issues.where("severity = 'REJECT'").withColumn("rn", rank).where(F.col("rn") <= k)
    text = F.concat("reason_code", F.lit(" ("), F.col("record_count").cast("string"), F.lit(")"))
    listed = top.withColumn("t", text).groupBy("batch_id", "source_file").agg(F.expr("listagg(t, ', ') WITHIN GROUP (ORDER BY rn)").alias(f"top_{k}_reject_reasons"))
    rate = percent(F.col("records_passed"), F.col("records_received"), 1)
    joined = scorecard.join(listed, ["batch_id", "source_file"], "left")
    return joined.select("batch_id", "source_file", "records_received", "records_passed", "records_rejected", "duplicates_removed", rate.alias("pass_rate_pct"), f"top_{k}_reject_reasons")


def incremental_counts(facts: DataFrame, log: DataFrame, dims: dict[str, DataFrame], batch_id: str, batch_date: dt.date) -> DataFrame:
    """K11a: what a batch brought, a row for each count."""
    count = lambda name, df: df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("metric"), "record_count")
    corrected = log.where(F.col("batch_id") == batch_id).select("transaction_id").distinct()
    out = count("New transactions", facts.where(F.col("source_batch_id") == batch_id)).unionByName(count("Corrected transactions", corrected))
    for name, dim in dims.items():
        new = dim.where((F.col("batch_id") == batch_id) & (F.col("valid_from") == F.lit(dt.date(1900, 1, 1))))
        out = out.unionByName(count(f"New {name}", new)).unionByName(count(f"{name.capitalize()} with new version", dim.where(F.col("valid_from") == F.lit(batch_date))))
    return out


def snapshot(of_customers: DataFrame, of_branches: DataFrame, customers: DataFrame, batch_id: str) -> DataFrame:
    """The rows of K1 and K7 as a batch leaves them, from transactions or partial sums with the attributes that each needs."""
    top, ranks = top_customers(of_customers, customers), branch_ranking(of_branches)
    one = top.select(F.lit("kpi01_top_customers").alias("kpi_name"), F.row_number().over(Window.orderBy("rank_no", "customer_id")).alias("rank_no"), F.col("customer_id").alias("item_key"), F.col("customer_name").alias("item_label"), F.col("net_value_inr").alias("metric_value"))
    label = F.concat("region", F.lit(" #"), F.col("rank_in_region").cast("string"))
    place = F.row_number().over(Window.orderBy("region", "rank_in_region", "branch_id"))  # a row for each branch
    two = ranks.select(F.lit("kpi07_branch_ranking").alias("kpi_name"), place.alias("rank_no"), F.col("branch_id").alias("item_key"), label.alias("item_label"), F.col("revenue_inr").alias("metric_value"))
    return one.unionByName(two).withColumn("batch_id", F.lit(batch_id)).withColumn("rank_no", F.col("rank_no").cast("long"))


def snapshot_deltas(snapshots: DataFrame, before: str, after: str) -> DataFrame:
    """K11b: each row of a later snapshot beside the earlier one's."""
    keys = ["kpi_name", "item_key"]
    side = lambda batch: [F.col("rank_no").alias(f"{batch}_rank"), F.col("metric_value").alias(f"{batch}_value")]
    old = snapshots.where(F.col("batch_id") == before).select(*keys, *side(before))
    new = snapshots.where(F.col("batch_id") == after).select(*keys, "item_label", *side(after))
    change = money(F.col(f"{after}_value") - F.coalesce(f"{before}_value", F.lit(0)))
    ranks, values = [f"{b}_rank" for b in (before, after)], [f"{b}_value" for b in (before, after)]
    return new.join(old, keys, "left").select(*keys, "item_label", *ranks, *values, change.alias("value_change"))


def kyc_transitions(customers: DataFrame) -> DataFrame:
    """K12: versions whose KYC status differs from that of the version they follow."""
    old = customers.select("customer_id", F.col("valid_to").alias("valid_from"), F.col("kyc_status").alias("from_status"))
    return customers.join(old, ["customer_id", "valid_from"]).where("from_status <> kyc_status").select(
        "customer_id", "customer_name", "from_status", F.col("kyc_status").alias("to_status"), F.col("valid_from").alias("changed_on"), "batch_id"
    )


def new_activations(facts: DataFrame, customers: DataFrame, batch_id: str) -> DataFrame:
    """K13: accounts whose first transaction came with a batch, and whether their customer did as well."""
    first = facts.groupBy("account_id").agg(F.min_by(F.struct("transaction_id", "txn_ts", "source_batch_id"), F.struct("txn_ts", "transaction_id")).alias("f")).select("account_id", "f.*")
    since = customers.where(F.col("valid_from") == F.lit(dt.date(1900, 1, 1))).select("customer_id", (F.col("batch_id") == batch_id).alias("newly_onboarded"))
    current = customers.where("is_current = 1").select("account_id", "customer_id", "customer_name")
    joined = first.where(F.col("source_batch_id") == batch_id).join(current, "account_id").join(since, "customer_id")
    return joined.select("account_id", "customer_id", "customer_name", F.col("transaction_id").alias("first_transaction_id"), F.col("txn_ts").alias("first_txn_ts"), "newly_onboarded")
