import datetime as dt
import json
from collections import Counter

import pytest
from ledgerwright.operators import dedupe
from ledgerwright.operators.cleaners import ENTITIES
from ledgerwright.sources import readers
from pyspark.sql import functions as F

DAY = dt.date(2026, 9, 30)
TXN = dict(transaction_id="T1", account_id="a1", product_id="P1", branch_id="B1", date="2026-09-01", timestamp="2026-09-01 10:00:00", amount="100", payment_method="upi", status="success", currency="inr", remarks="x", is_refund="N")
CUSTOMER = dict(customer_id="C1", customer_name="A", email="a@b.org", phone="9876543210", account_id="A1", gender="m", dob="1990-01-31", address="1 x st", kyc_status="verified", registration_date="2020-01-31", transaction_id="")


def settle(spark, name, rows, lost=()):
    columns = list(ENTITIES[name].columns)
    data = [(*(r.get(c) for c in columns), i, json.dumps(r, sort_keys=True), None) for i, r in enumerate(rows)]
    data += [(*(None for _ in columns), len(rows) + i, None, x) for i, x in enumerate(lost)]
    schema = ", ".join(f"{c} string" for c in columns) + ", _pos long, _raw string, _lost string"
    return dedupe.settle(spark.createDataFrame(data, schema), ENTITIES[name], DAY).cache()


def summary(df):
    card = dedupe.scorecard(df).first()
    assert card["records_received"] == card["records_passed"] + card["records_rejected"] + card["duplicates_removed"]
    return tuple(card), {(r["severity"], r["reason_code"]): r["record_count"] for r in dedupe.issue_counts(df).collect()}


@pytest.mark.parametrize("change,reasons", [
    (dict(transaction_id=" "), ["MISSING_KEY"]), (dict(timestamp="x"), ["INVALID_TIMESTAMP"]), (dict(timestamp="2026-10-01 00:00:00", date="2026-10-01"), ["FUTURE_DATED"]), (dict(is_refund="q"), ["INVALID_REFUND_FLAG"]),
    (dict(amount=""), ["MISSING_AMOUNT"]), (dict(amount="zz"), ["INVALID_AMOUNT"]), (dict(amount="0"), ["ZERO_AMOUNT"]), (dict(amount="-5"), ["NEGATIVE_AMOUNT"]), (dict(status="?"), ["INVALID_STATUS"]),
    (dict(payment_method=""), ["INVALID_PAYMENT_METHOD"]), (dict(currency="rupee"), ["INVALID_CURRENCY"]), (dict(amount="", status="?", account_id=""), ["MISSING_KEY", "MISSING_AMOUNT", "INVALID_STATUS"]),
])
def test_transaction_rejects(spark, change, reasons):
    out = settle(spark, "transactions", [TXN | change])
    assert dedupe.quarantine(out).first()["reason_codes"] == ";".join(reasons)


def test_transaction_flags_and_values(spark):
    out = settle(spark, "transactions", [TXN | dict(date="01/09/2026"), TXN | dict(transaction_id="T2", date="02/09/2026", is_refund="", currency="usd")])
    one, two = dedupe.clean_records(out).orderBy("transaction_id").collect()
    assert (one["account_id"], one["date_mismatch"], one["amount_inr"]) == ("A1", 0, 100)
    assert (two["date_mismatch"], two["needs_review"], two["amount_inr"], two["is_refund"], two["txn_date"]) == (1, 1, None, 0, dt.date(2026, 9, 1))
    assert summary(out)[1] == {("FLAG", c): 1 for c in ("DATE_MISMATCH", "MISSING_REFUND_FLAG", "NON_INR_CURRENCY")}


def test_conflicting_versions(spark):
    """Amounts 47753, 26116 and 47753 again: one exact repetition, and both versions quarantined."""
    out = settle(spark, "transactions", [TXN | dict(amount=a) for a in ("47753", "26116", "47753")])
    card, issues = summary(out)
    assert card == (3, 0, 2, 1)
    assert issues == {("REJECT", "CONFLICTING_DUPLICATE"): 2, ("FLAG", "EXACT_DUPLICATE"): 1}


def test_best_copy_and_owner(spark):
    rows = [CUSTOMER | dict(phone="1"), CUSTOMER, CUSTOMER | dict(gender="female"), CUSTOMER | dict(customer_id="C2", registration_date="2019-01-31"), CUSTOMER | dict(customer_id="C3", kyc_status="", email="")]
    out = settle(spark, "customers", rows)
    card, issues = summary(out)
    assert card == (5, 1, 2, 2)
    assert issues == {("FLAG", "NEAR_DUPLICATE_RESOLVED"): 2, ("REJECT", "SHARED_ACCOUNT_ID"): 1, ("REJECT", "INVALID_KYC_STATUS"): 1, ("FLAG", "MISSING_EMAIL"): 1}
    assert dedupe.clean_records(out).first()["customer_id"] == "C2"


def test_products_and_branches(spark):
    products = [dict(product_id="P1", product_name="", product_type="LOAN ", price="-31593", launch_date="", is_active="FALSE", category="Retail", vendor_name=" "), dict(product_id="P2", product_type="?", price="x", category="")]
    out = settle(spark, "products", products)
    first = dedupe.clean_records(out).first()
    assert (first["price"], first["is_active"], first["product_name"], first["vendor_name"]) == (31593, 0, None, None)
    assert dedupe.quarantine(out).first()["reason_codes"] == "INVALID_PRODUCT_TYPE;INVALID_CATEGORY;INVALID_PRICE"
    branches = [dict(branch_id="B1", branch_name="x", location="new DELHI", manager_name="", opened_date="07-08-2022", region="south ", branch_type="RURAL", contact_number="1")]
    out = settle(spark, "branches", branches)
    first = dedupe.clean_records(out).first()
    assert (first["manager_name"], first["location"], first["region"], first["branch_type"], first["opened_date"]) == ("UNKNOWN", "New Delhi", "South", "Rural", dt.date(2022, 8, 7))
    assert {c for _, c in summary(out)[1]} == {"MISSING_MANAGER", "INVALID_CONTACT", "AMBIGUOUS_DATE"}


def test_lost_fragments_and_references(spark):
    out = settle(spark, "transactions", [TXN, TXN | dict(transaction_id="T2", product_id="P9", branch_id="B9")], ["{cut"])
    known = lambda *x: spark.createDataFrame([(v,) for v in x], "k string")
    judged = dedupe.check_references(out, {"ORPHAN_ACCOUNT": ("account_id", known("A1", "A1")), "ORPHAN_PRODUCT": ("product_id", known("P1")), "ORPHAN_BRANCH": ("branch_id", known("B1"))})
    assert Counter(r["reason_codes"] for r in dedupe.quarantine(judged).collect()) == {"ORPHAN_PRODUCT;ORPHAN_BRANCH": 1, "MALFORMED_JSON": 1}
    assert summary(judged)[0] == (3, 1, 2, 0)


def test_csv_reader(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes(b'a,b,c\r\n1,,"x, ""y"""\r\nNA,NULL\r\n')
    rows = readers.read_csv(spark, str(path), ["a", "b", "c"]).orderBy("_pos").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [("1", "", 'x, "y"'), ("NA", "NULL", "")]
    path.write_bytes(b"a,b,c\n1,2,3,4\n")
    with pytest.raises(Exception, match="too many fields"):
        readers.read_csv(spark, str(path), ["a", "b", "c"]).select("a", F.col("b")).collect()


@pytest.mark.parametrize(("row", "fits"), [("1,2,,9", False), ('"x,y",2,,', False), ("1,2,", True), ("1", True), ('"x,y","a ""b"", c",', True), ('1,"2,3",4', True), (",,,", False), ('"1\n,",2,,9', False), ('"1\n,2,3",2,', True)])
def test_rows_with_too_many_fields_stop_the_read(spark, tmp_path, row, fits):
    path = tmp_path / "f.csv"
    path.write_text(f"a,b,c\n{row}\n")
    read = readers.read_csv(spark, str(path), ["a", "c"]).select("a")
    if fits:
        assert read.count() == 1 and len(read.collect()) == 1
    else:
        with pytest.raises(Exception, match="too many fields"):
            read.collect()


def test_metadata(spark, tmp_path):
    import hashlib

    (tmp_path / "f.csv").write_bytes(b"abc")
    assert tuple(readers.file_metadata(spark, str(tmp_path / "f.csv")).first()) == ("f.csv", 3, hashlib.sha256(b"abc").hexdigest())


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('b,more,"a"\n1,x,2\n3,,"4\n5"\n')
    rows = readers.read_csv(spark, str(path), ["a", "b"]).orderBy("_pos").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("2", "1"), ("4\n5", "3")]
    assert json.loads(rows[0]["_raw"]) == {"a": "2", "b": "1", "more": "x"}
    with pytest.raises(ValueError, match="no column c, d"):
        readers.read_csv(spark, str(path), ["a", "c", "d"])


def test_splits_keep_the_order_of_the_file(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(2000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        rows = readers.read_csv(spark, str(path), ["k", "v"])
        assert rows.rdd.getNumPartitions() > 1
        assert [int(r["k"]) for r in rows.orderBy("_pos").select("k").collect()] == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
