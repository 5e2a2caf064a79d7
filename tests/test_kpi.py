import datetime as dt

import pytest
from ledgerwright.plans import kpi, serving

SCHEMA = "transaction_id string, account_id string, customer_id string, branch_id string, branch_name string, region string, kyc_status string, txn_ts timestamp_ntz, txn_date date, amount int, amount_inr double, net_inr double, is_refund int"
#: account: (branch, region, KYC status, [(time, rupees, refund)])
ACCOUNTS = {
    "night": ("quay", "coast", "Verified", [("2025-03-31 23:54:30", 40, 0), ("2025-03-31 23:58:00", 41, 0), ("2025-04-01 00:04:30", 42, 0), ("2025-04-01 05:00:00", 43, 0), ("2025-04-01 04:59:59", 44, 0)]),
    "twice": ("quay", "coast", "Pending", [("2025-05-02 12:00:00", 100_000, 0), ("2025-05-02 12:00:00", 100_001, 0), ("2025-05-02 12:00:00", 7, 1)]),
    "apart": ("mill", "hills", "Rejected", [("2025-06-03 09:00:00", 310, 0), ("2025-06-03 09:05:00", 320, 0), ("2025-06-03 09:10:01", 330, 1)]),
    "fifth": ("dale", "hills", "Verified", [("2025-07-04 15:00:00", 300, 0)]),
    "sixth": ("dale", "hills", "Verified", [("2025-07-05 15:00:00", 300, 0)]),
    "small": ("dale", "hills", "Pending", [("2025-07-06 15:00:00", 3, 0), ("2025-07-07 15:00:00", 2, 1)]),
}


@pytest.fixture(scope="module")
def txn(spark):
    rows = []
    for account, (branch, region, kyc, made) in ACCOUNTS.items():
        for k, (ts, rupees, refund) in enumerate(made):
            at = dt.datetime.fromisoformat(ts)
            rows.append((f"{account}{k}", account, f"of {account}", branch, branch.upper(), region, kyc, at, at.date(), rupees, float(rupees), -float(rupees) if refund else float(rupees), refund))
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'Success' AS status", "'INR' AS currency", "customer_id AS customer_name")


def test_suspicious(txn):
    """A burst over midnight, three at one time, a burst that ends a second late, and the edges of value and hour."""
    got = {r["transaction_id"]: (r["txns_in_10_min"], r["risk_reason"]) for r in kpi.suspicious(txn).collect()}
    assert got == {
        "night2": (3, "VELOCITY_3_IN_10_MIN | ODD_HOURS"), "night4": (1, "ODD_HOURS"),
        "twice0": (3, "VELOCITY_3_IN_10_MIN"), "twice1": (3, "HIGH_VALUE | VELOCITY_3_IN_10_MIN"), "twice2": (3, "VELOCITY_3_IN_10_MIN"),
    }


def test_net_value_and_ranks(spark, txn):
    customers = spark.createDataFrame([(f"of {a}", a, a, 1) for a in ACCOUNTS], "customer_id string, customer_name string, account_id string, is_current int")
    top = [(r["rank_no"], r["account_id"], float(r["net_value_inr"]), r["txn_count"]) for r in kpi.top_customers(txn, customers).orderBy("rank_no", "customer_id").collect()]
    assert top == [(1, "twice", 199_994.0, 3), (2, "apart", 300.0, 3), (3, "fifth", 300.0, 1), (3, "sixth", 300.0, 1), (5, "night", 210.0, 5)]
    ranks = {r["branch_id"]: (float(r["revenue_inr"]), r["rank_in_region"], r["performer"]) for r in kpi.branch_ranking(txn).collect()}
    assert ranks == {"quay": (200_204.0, 1, "Top performer"), "dale": (601.0, 1, "Top performer"), "mill": (300.0, 2, "Bottom performer")}


def test_tie_at_the_last_rank(spark, txn):
    """Two customers share rank 3 of 3: the first by id stays, the list does not grow."""
    customers = spark.createDataFrame([(f"of {a}", a, a, 1) for a in ACCOUNTS], "customer_id string, customer_name string, account_id string, is_current int")
    assert [r["account_id"] for r in kpi.top_customers(txn, customers, 3).orderBy("rank_no").collect()] == ["twice", "apart", "fifth"]


def test_exposure_is_at_transaction_time(txn):
    got = {r["kyc_status"]: (r["txn_count"], float(r["value_inr"]), r["at_risk"]) for r in kpi.kyc_exposure(txn).collect()}
    assert got == {"Verified": (7, 810.0, False), "Pending": (5, 199_995.0, True), "Rejected": (3, 300.0, True)}
    one = serving.at_risk(kpi.kyc_exposure(txn)).first()
    assert (one["count_pct"], float(one["value_inr"])) == (53.3, 200_295.0)


def test_transitions(spark):
    first, moved, later, end = dt.date(1900, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 8, 9), dt.date(9999, 12, 31)
    rows = [("c7", "N", "Pending", first, moved, "one"), ("c7", "N", "Rejected", moved, later, "two"), ("c7", "M", "Rejected", later, end, "three"), ("c8", "O", "Verified", first, end, "one")]
    df = spark.createDataFrame(rows, "customer_id string, customer_name string, kyc_status string, valid_from date, valid_to date, batch_id string")
    assert [(r["from_status"], r["to_status"]) for r in kpi.kyc_transitions(df).collect()] == [("Pending", "Rejected")]


@pytest.mark.parametrize("minutes", [1, 10])
def test_bursts_at_the_edges_of_slices(spark, minutes):
    """One hot account, with times on and beside the edges of slices, equals a count over all pairs."""
    length = 60 * minutes * kpi.SLICE_WINDOWS
    start = dt.datetime(1969, 12, 31, 22)
    offsets = sorted({max(0, k * length + d) for k in range(5) for d in (-60 * minutes - 1, -60 * minutes, -60 * minutes + 1, -1, 0, 1, 60 * minutes, 60 * minutes + 1)}) * 2
    times = [start + dt.timedelta(seconds=s, microseconds=u) for s in offsets for u in (0, 500_000)]
    rows = [(k, "hot", t) for k, t in enumerate(times)] + [(-1, "hot", None)]
    df = spark.createDataFrame(rows, "id int, account_id string, txn_ts timestamp_ntz")
    got = {r["id"]: r["n"] for r in kpi.with_burst(df, "n", minutes).where("id >= 0").collect()}
    window = dt.timedelta(minutes=minutes)
    assert got == {k: sum(t - window <= u <= t for u in times) for k, t in enumerate(times)}
    assert kpi.with_burst(df, "n", minutes).count() == len(rows)


def test_thirds_of_equal_values(spark):
    """Rows of one value are numbered in several ranges, in order of their key."""
    df = spark.createDataFrame([(f"c{i:04}", 1) for i in range(1000)], "customer_id string, v int")
    plan = kpi.tiles(df, [("v", True, "t")])
    got = [r["t"] for r in plan.orderBy("customer_id").collect()]
    assert got == [1] * 334 + [2] * 333 + [3] * 333


def test_thirds(spark):
    df = spark.createDataFrame([(f"c{i:03}", (i * 7) % 13) for i in range(50)], "customer_id string, v int")
    got = {r["customer_id"]: r["t"] for r in kpi.tiles(df, [("v", False, "t"), ("v", True, "u")]).collect()}
    order = sorted(got, key=lambda c: ((int(c[1:]) * 7) % 13, c))
    assert [got[c] for c in order] == [1] * 17 + [2] * 17 + [3] * 16


def test_no_division_by_zero(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(kpi.percent(F.lit(1), F.lit(0), 1)).first()[0] is None


def test_search_is_literal(spark):
    df = spark.createDataFrame([("A%b", None), (None, "a_b"), ("AB", "x")], "k string, r string")
    assert serving.search(df, "a%", ["k", "r"]).count() == 1 and serving.search(df, "a", ["k", "r"]).count() == 3


def test_results_are_kept_until_the_next_version(spark):
    class Store:
        published = {"fact": "v1"}

        def latest(self):
            return dict(self.published)

    made, store = [], Store()
    cache = serving.Cache(store)
    build = lambda: made.append(1) or spark.range(3)
    assert cache.get("n", build).count() == 3 and cache.get("n", build).count() == 3 and len(made) == 1
    store.published = {"fact": "v2"}
    assert cache.get("n", build).count() == 3 and len(made) == 2
    cache.clear()


def test_values_are_listed_where_they_are_few(spark):
    df = spark.createDataFrame([(str(i % 3) if i % 4 else "", str(i)) for i in range(40)], "few string, many string")
    got = {(r["column_name"], r["value"]): r["n"] for r in serving.value_listing(df).collect()}
    assert set(got) == {("few", v) for v in ("", "0", "1", "2")} and sum(got.values()) == 40


def test_both_levels_in_one_pass(txn):
    """Branches and regions from grouping sets are the rows of the two metrics, from transactions as from sums."""
    dated = txn.selectExpr("*", "trunc(txn_date, 'MM') AS month_start")
    both = kpi.monthly_levels(dated)
    for level, alone in (("branch", kpi.branch_monthly(dated)), ("region", kpi.region_monthly(dated))):
        got = both.where(f"level = '{level}'").select(*alone.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, alone.collect())) != []
    assert {r["branch_id"] for r in both.where("level = 'region'").collect()} == {None}
