import duckdb
import pytest
from ledgerwright.plans import registry

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_only_what_sql_cannot_say_lacks_sql():
    assert set(registry.queries()) - set(ORACLES) == {"file_metadata"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_salvage_recovers_every_object(spark, sf):
    rows = registry.queries()["json_salvage"](spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    assert rows.where("record IS NOT NULL").agg({"n": "sum"}).first()[0] == events
