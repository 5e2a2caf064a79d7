import datetime as dt
from decimal import Decimal

import pytest
from ledgerwright.functions import codes
from ledgerwright.functions import text as tx
from pyspark.sql import functions as F


def run(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    assert run(spark, tx.clean_text, "  a \t b\xa0c ", None, "") == ["a b c", "", ""]


def test_title_case(spark):
    assert run(spark, tx.title_case, "544 park ave-east", "éa b-c 5th", "o'neil  x", None) == ["544 Park Ave-East", "Éa B-C 5Th", "O'Neil X", ""]


def test_lookup(spark):
    assert run(spark, lambda c: tx.lookup(c, codes.STATUS), " Sucess ", "FAILD", "x", None) == ["Success", "Failed", None, None]
    assert run(spark, lambda c: tx.lookup(c, codes.REFUND), "Y", "0", "") == [True, False, None]
    assert run(spark, tx.parse_bool, "TRUE", "false", "1", None) == [True, False, None, None]


def test_parse_amount(spark):
    got = run(spark, tx.parse_amount, "Rs.81250", "₹1,200", "163,970", " 500 ", "0.125", "0.375", "-3.5", "1e2", "", "abc", "NaN", None, "INR 7")
    assert got == [Decimal(x) if x else None for x in ("81250.00", "1200.00", "163970.00", "500.00", "0.12", "0.38", "-3.50", "100.00", "", "", "", "", "7.00")]


def test_dates(spark):
    d = dt.date
    assert run(spark, tx.date_candidates, "2026-09-30", "01/10/2026", "13/02/2020", "02-13-2020", "31/04/2021", "5/5/2020", "x", None) == [
        [d(2026, 9, 30)], [d(2026, 10, 1), d(2026, 1, 10)], [d(2020, 2, 13)], [d(2020, 2, 13)], [], [d(2020, 5, 5)], [], []]
    assert run(spark, tx.parse_date, "07-08-2022", "") == [d(2022, 8, 7), None]
    assert run(spark, tx.is_ambiguous_date, "07-08-2022", "13-08-2022") == [True, False]
    assert run(spark, tx.parse_timestamp, "2026-09-01 10:04:00", "2026-9-1 1:2:3", "2026-02-30 00:00:00", "2026-09-01") == [dt.datetime(2026, 9, 1, 10, 4), dt.datetime(2026, 9, 1, 1, 2, 3), None, None]


def test_contacts(spark):
    assert run(spark, lambda c: tx.clean_email(c).value, " A@B.org", "bad", "") == ["a@b.org", "bad", None]
    assert run(spark, lambda c: tx.clean_email(c).valid, "A@b.org", "a@b", "x y@b.org") == [True, False, False]
    assert run(spark, lambda c: tx.clean_phone(c).value, "+91 98765-43210", "919876543210", "9876543210", "12345", "") == ["+91-9876543210"] * 3 + ["12345", None]


def test_display_and_export(spark):
    assert run(spark, tx.shape, "AB-12", " ", None) == ["AA-99", "<blank>", "<blank>"]
    assert run(spark, tx.safe_cell, "=1+1", "a", "@x", None) == ["'=1+1", "a", "'@x", None]
    assert run(spark, lambda c: tx.rupees(c.cast("double")), "1234567", None) == ["₹1,234,567", "–"]
    assert run(spark, tx.clean_remarks, "late [late correction]", "[late correction]", None) == ["late", None, None]


@pytest.mark.parametrize("a,b,same", [((None, "x"), ("", "x"), False), (("a", "b"), ("a", "b"), True), (("ab", ""), ("a", "b"), False)])
def test_row_hash(spark, a, b, same):
    df = spark.createDataFrame([a, b], "p string, q string").select(tx.row_hash([("p", "string"), ("q", "string")]))
    one, two = (r[0] for r in df.collect())
    assert (one == two) is same
