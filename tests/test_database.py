import datetime as dt

import pytest
from ledgerwright.sources import database
from ledgerwright.sources.database import read_table, write_table

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_rows_survive_a_round_trip_in_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = [(i, None if i % 10 == 0 else i * 3, f"v{i}", dt.date(2026, 1, 1) + dt.timedelta(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, n int, v string, day date")
    write_table(df, url, "t", **DRIVER)
    for column in ("k", "n", "day"):
        found = read_table(spark, url, "t", column, 4, **DRIVER)
        assert found.rdd.getNumPartitions() == 4
        assert sorted(map(tuple, found.collect())) == sorted(rows, key=lambda r: r[0])
    some = read_table(spark, url, "t", "k", 4, **DRIVER).where("k = 7").select("v")
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull" in plan and [r["v"] for r in some.collect()] == ["v7"]


def test_an_empty_table_is_one_read(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    write_table(spark.createDataFrame([], "k int"), url, "t", **DRIVER)
    found = read_table(spark, url, "t", "k", 4, **DRIVER)
    assert found.count() == 0 and found.rdd.getNumPartitions() == 1


def test_publication_is_whole_and_repeatable(spark, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/pub;create=true", DRIVER | {"createTableColumnTypes": "batch_id VARCHAR(20)"}
    rows = lambda batch, *ks: spark.createDataFrame([(k, batch) for k in ks], "k int, batch_id string").repartition(3)
    database.write_table(rows("day1", 1, 2), url, "facts", "overwrite", **options)
    read = lambda: sorted((r["k"], r["batch_id"]) for r in database.read_table(spark, url, "facts", **options).collect())
    for _ in range(2):
        assert database.publish_table(rows("day2", 3, 4, 5), url, "facts", "run-2", ("batch_id", "day2"), **options) == 3
        assert read() == [(1, "day1"), (2, "day1"), (3, "day2"), (4, "day2"), (5, "day2")]
    # a row that the table can't take: nothing of the run is left, and what was there stays
    bad = rows("day2", 9).selectExpr("k", "batch_id", "k AS more")
    with pytest.raises(Exception, match="(?i)more"):
        database.publish_table(bad, url, "facts", "run-3", ("batch_id", "day2"), **options)
    assert len(read()) == 5
    with pytest.raises(Exception, match="(?i)facts_run3"):
        database.read_table(spark, url, "facts_run3", **options).collect()
    assert database.publish_table(rows("day3"), url, "facts", "run-4", **options) == 0 and read() == []
