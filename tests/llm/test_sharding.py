from collections import Counter

from ledgerwright.llm import sharding


def test_table_is_full_and_even():
    size = sharding.table_size(13)
    assert size == 1301
    counts = Counter(sharding.fill_table([f"n{i}" for i in range(13)], size))
    assert sum(counts.values()) == size and max(counts.values()) - min(counts.values()) <= 1


def test_losing_a_shard_moves_little():
    names = [f"n{i}" for i in range(10)]
    size = sharding.table_size(10)
    before = [names[i] for i in sharding.fill_table(names, size)]
    after = [names[:9][i] for i in sharding.fill_table(names[:9], size)]
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != "n9")
    assert moved < 0.25 * size


def test_assign(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x") for i in range(500)] + [(None, "y"), (7, "again")], "doc_id long, shard string")
    out = sharding.assign_shards(docs, 5).collect()
    assert len(out) == 502 and all(r["shard"] for r in out)
    assert len({r["shard"] for r in out if r["doc_id"] == 7}) == 1
    assert sharding.assign_shards(docs.where("false"), 5).count() == 0
    assert "Exchange" not in sharding.assign_shards(docs, 5)._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    sharding.write_shards(docs.drop("shard"), str(tmp_path / "out"), 3, files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 502
