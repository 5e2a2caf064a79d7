import csv
import datetime as dt
import json

import pytest
from ledgerwright.operators.cleaners import ENTITIES
from ledgerwright.plans import batch, kpi
from ledgerwright.plans.warehouse import ConflictError, ConstraintError, Warehouse, require_unique
from ledgerwright.sources import landing
from ledgerwright.streaming.batches import watch

from tests.test_settle import CUSTOMER, TXN

FILES = {e: f"{e}.json" if e == "products" else f"{e}.csv" for e in ENTITIES}
PRODUCT = dict(product_id="P1", product_name="p", product_type="loan", price=10, launch_date="2020-01-31", is_active=True, category="retail", vendor_name="v")
BRANCH = dict(branch_id="B1", branch_name="b", location="x", manager_name="m", opened_date="2020-01-31", region="north", branch_type="urban", contact_number="9876543210")


def put(folder, rows, products_text=None):
    folder.mkdir(parents=True)
    for name, some in rows.items():
        columns = ENTITIES[name].columns
        if name == "products":
            (folder / FILES[name]).write_text(products_text or json.dumps(some))
            continue
        with open(folder / FILES[name], "w", newline="") as f:
            out = csv.DictWriter(f, columns)
            out.writeheader()
            out.writerows(some)


@pytest.fixture
def calendar(tmp_path):
    raw = tmp_path / "raw"
    put(raw / "day1", {
        "customers": [CUSTOMER, CUSTOMER | dict(customer_id="C2", account_id="A2", kyc_status="pending")], "products": [PRODUCT], "branches": [BRANCH],
        "transactions": [TXN | dict(status="failed"), TXN | dict(transaction_id="T2", account_id="A2"), TXN | dict(transaction_id="T3", account_id="A9")],
    }, products_text=json.dumps([PRODUCT])[:-1] + ' {"product_id": ')
    put(raw / "day2", {
        "customers": [CUSTOMER | dict(customer_id="C2", account_id="A2", kyc_status="verified"), CUSTOMER | dict(customer_name="Renamed")], "products": [PRODUCT], "branches": [BRANCH],
        "transactions": [TXN | dict(remarks="ok [late correction]"), TXN | dict(transaction_id="T4", account_id="A2", timestamp="2026-10-01 09:00:00", date="2026-10-01")],
    })
    return batch.Calendar(str(raw), {"day1": dt.date(2026, 9, 30), "day2": dt.date(2026, 10, 1)}, {"day1": FILES, "day2": FILES})


def test_two_days_replays_and_views(spark, calendar, tmp_path):
    root = str(tmp_path / "wh")
    zone = str(tmp_path / "zone")
    one = batch.run_batch(spark, "day1", calendar, root, zone)
    assert (tmp_path / "zone/bronze/batch=day1/customers.csv").exists() and (tmp_path / "zone/quarantine/batch=day1/transactions").exists()
    assert one.actions["transactions"] == {"inserted": 2} and one.counts["products"]["records_rejected"] == 1
    two = batch.run_batch(spark, "day2", calendar, root)
    assert two.actions["customers"] == {"new_version": 1, "updated_in_place": 1} and two.actions["transactions"] == {"corrected": 1, "inserted": 1}
    again = batch.run_batch(spark, "day2", calendar, root)
    assert again.actions["transactions"] == {"unchanged": 2} and again.actions["customers"] == {"unchanged": 2}
    older = batch.run_batch(spark, "day1", calendar, root)
    assert older.actions["transactions"] == {"skipped_newer_exists": 1, "unchanged": 1} and older.actions["customers"] == {"skipped_newer_exists": 2}

    views = batch.register_views(spark, root, calendar)
    assert {"kpi11_incremental_counts", "kpi13_new_activations"} <= set(views)
    assert {r["metric"]: r["record_count"] for r in spark.table("kpi11_incremental_counts").collect()}["Corrected transactions"] == 1
    log = spark.table("fact_correction_log").collect()
    assert [(r["old_values"], r["new_values"]) for r in log] == [({"status": "Failed", "remarks": "x"}, {"status": "Success", "remarks": "ok"})]
    # metrics over daily sums are those over the facts
    facts, c, p, b = (spark.table(t) for t in ("fact_transaction", "dim_customer", "dim_product", "dim_branch"))
    for name, whole in {
        "kpi01_top_customers": kpi.top_customers(kpi.point_in_time(facts), c), "kpi02_branch_monthly": kpi.branch_monthly(kpi.point_in_time(facts, branches=b)), "kpi03_product_share": kpi.product_share(kpi.point_in_time(facts, products=p)),
        "kpi06_customer_segments": kpi.segments(kpi.point_in_time(facts), facts, c), "kpi09_refund_by_product": kpi.refunds_by_product(kpi.point_in_time(facts, products=p)),
    }.items():
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, whole.collect())) != []
    versions = spark.table("dim_customer").where("customer_id = 'C2'").orderBy("valid_from").collect()
    assert [(r["kyc_status"], r["valid_from"], r["valid_to"], r["is_current"]) for r in versions] == [("Pending", dt.date(1900, 1, 1), dt.date(2026, 10, 1), 0), ("Verified", dt.date(2026, 10, 1), dt.date(9999, 12, 31), 1)]
    at = {r["transaction_id"]: r["kyc_status"] for r in spark.table("v_txn").collect()}
    assert at == {"T1": "Verified", "T2": "Pending", "T4": "Verified"}
    assert spark.table("kpi12_kyc_transitions").count() == 1
    assert spark.table("dq_scorecard").count() == 8 and spark.table("kpi_snapshot").select("batch_id").distinct().count() == 2
    issues = {(r["batch_id"], r["reason_code"]) for r in spark.table("dq_issue_counts").collect()}
    assert {("day1", "ORPHAN_ACCOUNT"), ("day1", "MALFORMED_JSON"), ("day1", "MALFORMED_JSON_SALVAGED")} <= issues
    assert batch.last_run(spark, root).first()["status"] == "SUCCESS"


def test_failures_leave_the_tables(spark, calendar, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    batch.run_batch(spark, "day1", calendar, root)
    before = Warehouse(spark, root).tables()
    monkeypatch.setattr(batch, "_snapshot", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        batch.run_batch(spark, "day2", calendar, root)
    assert Warehouse(spark, root).tables() == before and batch.last_run(spark, root).first()["status"] == "FAILED"
    with pytest.raises(ValueError, match="unknown batch"):
        batch.run_batch(spark, "day9", calendar, root)
    (tmp_path / "raw" / "day2" / "branches.csv").write_text("")
    with pytest.raises(FileNotFoundError):
        batch.run_batch(spark, "day2", calendar, root)
    with pytest.raises(ValueError):
        Warehouse(spark, root).drop()
    Warehouse(spark, root).drop(yes=True)
    assert Warehouse(spark, root).tables() == {}


def test_a_batch_writes_only_the_days_it_changes(spark, calendar, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "wh")
    at = lambda k, day: TXN | dict(transaction_id=k, timestamp=f"{day} 08:00:00", date=day)
    put(raw / "first", {"customers": [CUSTOMER], "products": [PRODUCT], "branches": [BRANCH], "transactions": [at("T1", "2026-09-01"), at("T2", "2026-09-01"), at("T3", "2026-09-02"), at("T4", "2026-09-03")]})
    put(raw / "second", {"customers": [CUSTOMER | dict(customer_id="C7", account_id="A7")], "products": [PRODUCT], "branches": [BRANCH], "transactions": [at("T3", "2026-09-04"), at("T5", "2026-09-01")]})
    days = batch.Calendar(str(raw), {"first": dt.date(2026, 9, 30), "second": dt.date(2026, 10, 1)}, {"first": FILES, "second": FILES})
    batch.run_batch(spark, "first", days, root)
    before = Warehouse(spark, root).tables()
    assert set(before["fact_transaction"]) == {"2026-09-01", "2026-09-02", "2026-09-03"}
    run = batch.run_batch(spark, "second", days, root)
    assert run.actions["transactions"] == {"corrected": 1, "inserted": 1}
    after = Warehouse(spark, root).tables()
    # a fact that moved leaves its old day, here empty; a day without records stays the same folder
    assert set(after["fact_transaction"]) == {"2026-09-01", "2026-09-03", "2026-09-04"}
    same = {d for d, p in before["fact_transaction"].items() if after["fact_transaction"].get(d) == p}
    assert same == {"2026-09-03"}
    # of a dimension only the buckets of the batch's keys are written
    assert before["dim_customer"].items() < after["dim_customer"].items() and len(after["dim_customer"]) == 2
    assert {r["customer_id"] for r in Warehouse(spark, root).read("dim_customer", "").collect()} == {CUSTOMER["customer_id"], "C7"}
    for table in batch.PARTIALS:
        assert set(after[table]) == set(after["fact_transaction"]) and {d for d, p in before[table].items() if after[table].get(d) == p} == same
    assert after["dq_scorecard"]["first"] == before["dq_scorecard"]["first"] and set(after["dq_scorecard"]) == {"first", "second"}
    assert set(after["fact_correction_log"]) > set(before["fact_correction_log"])
    facts = Warehouse(spark, root).read("fact_transaction", batch.FACT)
    found = {r["transaction_id"]: str(r["txn_date"]) for r in facts.collect()}
    assert found == {"T1": "2026-09-01", "T2": "2026-09-01", "T3": "2026-09-04", "T4": "2026-09-03", "T5": "2026-09-01"}
    assert not list((tmp_path / "wh").glob("scratch=*")) and not list((tmp_path / "wh").glob("v=*/joined_*"))
    assert batch.check(spark, root) == []
    store = Warehouse(spark, root)
    store.stage("fact_transaction", facts.unionByName(facts.where("transaction_id = 'T1'")))
    store.stage("dim_product", store.read("dim_product", "k int").drop("price"))
    store.publish()
    assert batch.check(spark, root) == ["dim_product.price is missing, not decimal(15,2)"]


def test_a_batch_reads_only_the_days_that_may_hold_its_keys(spark, calendar, tmp_path, monkeypatch):
    """Facts are read of days that the index names, without an index of all; the index follows what is corrected and moved."""
    raw, root = tmp_path / "raw", str(tmp_path / "wh")
    at = lambda k, day: TXN | dict(transaction_id=k, timestamp=f"{day} 08:00:00", date=day)
    base = {"customers": [CUSTOMER], "products": [PRODUCT], "branches": [BRANCH]}
    put(raw / "one", base | {"transactions": [at(f"T{d}", f"2026-09-0{d}") for d in range(1, 7)]})
    put(raw / "two", base | {"transactions": [at("T2", "2026-09-08"), at("T9", "2026-09-01")]})
    put(raw / "three", base | {"transactions": [at("T2", "2026-09-09"), at("T4", "2026-09-04")]})
    dates = {"one": dt.date(2026, 9, 10), "two": dt.date(2026, 9, 11), "three": dt.date(2026, 9, 12)}
    plan = batch.Calendar(str(raw), dates, dict.fromkeys(dates, FILES))
    read, seen = Warehouse.read, []

    def noted(self, name, schema, only=None):
        if name == "fact_transaction":
            seen.append(only)
        return read(self, name, schema, only)

    batch.run_batch(spark, "one", plan, root)
    monkeypatch.setattr(Warehouse, "read", noted)
    batch.run_batch(spark, "two", plan, root)
    # first the days to look for keys in, then those to merge, then those written
    assert [sorted(s) for s in seen] == [["2026-09-02"], ["2026-09-01", "2026-09-02", "2026-09-08"], ["2026-09-01", "2026-09-08"]]
    seen.clear()
    batch.run_batch(spark, "three", plan, root)
    assert [sorted(s) for s in seen] == [["2026-09-04", "2026-09-08"], ["2026-09-04", "2026-09-08", "2026-09-09"], ["2026-09-04", "2026-09-09"]]
    store = Warehouse(spark, root)
    assert set(store.parts(batch.KEY_INDEX)) == set(store.parts("fact_transaction")) == {f"2026-09-0{d}" for d in (1, 3, 4, 5, 6, 9)}
    # a warehouse of before the index was kept: all days count as such that may hold a key
    del store.tables()[batch.KEY_INDEX]
    assert batch._days_with_keys_of(store, spark.createDataFrame([("T1",)], "transaction_id string")) == set(store.parts("fact_transaction"))


def test_constraints(spark):
    with pytest.raises(ConstraintError):
        require_unique("t", spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_landing_and_quarantine_sink(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("x")
    bronze = str(tmp_path / "bronze")
    assert not landing.land(spark, str(f), None, "d1")
    assert landing.land(spark, str(f), bronze, "d1") and not landing.land(spark, str(f), bronze, "d1")
    f.write_text("y")
    assert landing.land(spark, str(f), bronze, "d1") and (tmp_path / "bronze/batch=d1/a.csv").read_text() == "y"
    rows = spark.createDataFrame([("k", "R", '{"a": "b, c"}')], "record_key string, reason_codes string, raw_record string")
    assert landing.write_quarantine(rows, str(tmp_path / "q")) and not landing.write_quarantine(rows.where("false"), str(tmp_path / "q2"))


def test_stream_of_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("day10\nday2\n\nday9\nday1\n")
    seen = []
    for _ in range(2):
        watch(spark, str(tmp_path / "in"), str(tmp_path / "cp"), seen.append, [f"day{k}" for k in range(1, 11) if k != 9]).awaitTermination(60)
    assert seen == ["day1", "day2", "day10", "day9"]


def test_a_broken_file_without_loss_is_flagged(spark, calendar, tmp_path):
    """A missing comma loses nothing, but the file is broken; its rows are the records that could be read."""
    products = tmp_path / "raw" / "day1" / "products.json"
    products.write_text(json.dumps(PRODUCT) + " " + json.dumps(PRODUCT | dict(product_id="P2")))
    batch.run_batch(spark, "day1", calendar, str(tmp_path / "a"))
    products.write_text("[" + json.dumps(PRODUCT) + ", {cut")
    batch.run_batch(spark, "day1", calendar, str(tmp_path / "b"))
    products.write_text(json.dumps([PRODUCT]))
    batch.run_batch(spark, "day1", calendar, str(tmp_path / "c"))
    for root, flags, rows, received in (("a", {"MALFORMED_JSON_SALVAGED": 1}, 2, 2), ("b", {"MALFORMED_JSON_SALVAGED": 1, "MALFORMED_JSON": 1}, 1, 2), ("c", {}, 1, 1)):
        store = Warehouse(spark, str(tmp_path / root))
        issues = store.read("dq_issue_counts", "").where("entity = 'products'").collect()
        assert {r["reason_code"]: r["record_count"] for r in issues} == flags
        assert store.read("ingestion_log", "").where("entity = 'products'").first()["row_count"] == rows
        assert store.read("dq_scorecard", "").where("entity = 'products'").first()["records_received"] == received
        assert set(store.tables()) == set(batch.schemas()) and not list((tmp_path / root).glob("*/settled_*"))


def test_two_runs_at_once(spark, calendar, tmp_path, monkeypatch):
    """The second of two runs that read the same tables may not publish; the batch is worked out again, and nothing is lost."""
    root = str(tmp_path / "wh")
    publish, inside = Warehouse.publish, []

    def late(self):
        if not inside:
            inside.append(True)
            batch.run_batch(spark, "day1", calendar, root)
        return publish(self)

    monkeypatch.setattr(Warehouse, "publish", late)
    two = batch.run_batch(spark, "day2", calendar, root)
    assert two.actions["transactions"] == {"corrected": 1, "inserted": 1}
    facts = Warehouse(spark, root).read("fact_transaction", batch.FACT)
    assert {r["transaction_id"] for r in facts.collect()} == {"T1", "T2", "T4"}
    assert set(Warehouse(spark, root).parts("dq_scorecard")) == {"day1", "day2"}
    runs = [r["status"] for r in spark.read.parquet(f"{root}/pipeline_runs").orderBy("at").collect()]
    assert sorted(runs) == ["FAILED", "RUNNING", "RUNNING", "RUNNING", "SUCCESS", "SUCCESS"]
    assert Warehouse(spark, root).numbers() == [1, 2] and len(list((tmp_path / "wh").glob("v=*"))) == 2


def test_conflicts_and_sweep(spark, tmp_path):
    root = str(tmp_path / "wh")
    row = lambda k: spark.createDataFrame([(k,)], "k int")
    one, two = Warehouse(spark, root), Warehouse(spark, root)
    for store in (one, two):
        store.tables()
        store.stage("t", row(1), part="a")
    assert one.publish() == 1
    with pytest.raises(ConflictError):
        two.publish()
    two.clear(published=False)
    for k in (2, 3):
        store = Warehouse(spark, root)
        store.stage("t", row(k), part="b")
        store.stage("u", row(k))
        store.stage("s", row(k), keep=False)
        store.publish()
    now = Warehouse(spark, root).tables()
    assert Warehouse(spark, root).sweep(keep=3) == []
    gone = Warehouse(spark, root).sweep(keep=1, idle_seconds=0)
    assert {"1", "2"} <= set(gone) and Warehouse(spark, root).numbers() == [3] and Warehouse(spark, root).tables() == now
    assert sorted(r["k"] for r in Warehouse(spark, root).read("t", "k int").collect()) == [1, 3]
    left = {p.relative_to(root).as_posix() for p in (tmp_path / "wh").glob("*=*/*/*") if p.suffix == ".parquet" or p.is_dir()}
    assert {p.split("/")[0] for p in left} == {p.removeprefix(root + "/").split("/")[0] for parts in now.values() for p in parts.values()}


def test_command_line(calendar, tmp_path, monkeypatch, capsys, spark):
    from ledgerwright import cli

    found = {"raw": calendar.raw, "batches": {b: {"date": str(d), "files": FILES} for b, d in calendar.dates.items()}}
    (tmp_path / "c.json").write_text(json.dumps(found))
    monkeypatch.setenv("LEDGERWRIGHT_CALENDAR", str(tmp_path / "c.json"))
    monkeypatch.setenv("LEDGERWRIGHT_WAREHOUSE", str(tmp_path / "wh"))
    assert cli.main(["run", "--batch-id", "day1"]) == 0 and cli.main(["run", "--batch-id", "day7"]) == 1
    assert cli.main(["check"]) == 0
    assert cli.main(["drill", "--batch-id", "day1"]) == 0 and capsys.readouterr().out.count("pass  ") == 6
    assert not list((tmp_path / "wh").glob("drill=*")) and len(list((tmp_path / "wh").glob("v=*"))) == 2
    assert cli.main(["drill", "--batch-id", "day2"]) == 1  # it has not run yet, so its replay brings new rows
    assert cli.main(["sweep", "--keep", "1", "--idle-seconds", "0"]) == 0
    assert cli.main(["report"]) == 0 and "ORPHAN_ACCOUNT" in capsys.readouterr().out
    assert cli.main(["reset"]) == 1 and cli.main(["reset", "--yes"]) == 0
