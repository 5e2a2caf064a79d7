"""Rows of a table that differ in nothing but their number are different records of its file."""

import datetime as dt

import duckdb
import pytest
from ledgerwright.plans import registry

DAY = dt.datetime(1996, 1, 2)
#: Numbers whose records have every value in common, and one more.
PARTS = [1615 * k for k in range(1, 40)]
ORDERS = [17 * 12 * 29 * 11 * 250 * 19 * 31 * 37 * 13 * 41 * k for k in range(1, 4)]
CUSTOMERS = [17 * 3 * 700 * 23 * k for k in range(1, 4)]
TABLES = {
    "settle_products": ("part", "p_partkey long", [(k,) for k in [*PARTS, 7]]),
    "settle_transactions": ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(k, 5, DAY) for k in [*ORDERS, 7]]),
    "settle_customers": ("customer", "c_custkey long, c_name string", [(k, "one name") for k in [*CUSTOMERS, 8]]),
}


@pytest.mark.parametrize("name", TABLES)
def test_equal_values_of_other_rows_are_no_exact_duplicates(spark, tmp_path, name):
    table, schema, rows = TABLES[name]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = registry.queries()[name](spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


NEW_YEAR = dt.datetime(1980, 1, 1)
ODD = {
    "a day that dates were made of": ("settle_transactions", "orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(k, 5, day) for k, day in ((4, NEW_YEAR), (6, NEW_YEAR), (8, DAY))]),
    "numbers below 0": ("settle_transactions", "orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(k, 5, DAY) for k in range(-1100, 20)]),
    "orders by doubles": ("settle_transactions", "orders", "o_orderkey double, o_custkey long, o_orderdate timestamp_ntz", [(float(k), 5, DAY) for k in (4, 10, 11, 50, 20_000_000)]),
    "parts by doubles": ("settle_products", "part", "p_partkey double", [(float(k),) for k in (4, 10, 11, 50, 20_000_000)]),
    "suppliers by doubles": ("settle_branches", "supplier", "s_suppkey double", [(float(k),) for k in (4, 10, 11, 50, 20_000_000)]),
}


@pytest.mark.parametrize("odd", ODD)
def test_records_of_odd_numbers_and_days_settle_as_the_sql_says(spark, tmp_path, odd):
    name, table, schema, rows = ODD[odd]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = registry.queries()[name](spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
