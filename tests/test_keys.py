import random

from ledgerwright.operators import keys
from pyspark.sql import functions as F


def names(df):
    return {r["held_in"] for r in df.collect()}


def test_no_part_that_holds_a_key_is_missing(spark):
    r = random.Random(5)
    parts = {f"d{p:02}": {f"T{r.randrange(10**6)}" for _ in range(r.choice((1, 40, 900)))} for p in range(30)}
    rows = [(k, p) for p, ks in parts.items() for k in ks] + [(None, "d00"), (next(iter(parts["d03"])), "d03")]
    index = keys.summaries(spark.createDataFrame(rows, "k string, p string"), "k", F.col("p")).cache()
    assert names(index) == set(parts)
    extra = 0
    for _ in range(6):
        some = {r.choice(sorted(parts[p])) for p in r.sample(sorted(parts), 3)} | {f"T{10**6 + r.randrange(10**6)}" for _ in range(3)}
        found = names(keys.may_hold(index, spark.createDataFrame([(k, 0) for k in some], "k string, held_in int"), "k"))
        held = {p for p, ks in parts.items() if ks & some}
        assert held <= found
        extra += len(found - held)
    assert extra <= 2
    assert names(keys.may_hold(index, spark.createDataFrame([(None,)], "k string"), "k")) == set()
    assert names(keys.may_hold(index.where("false"), spark.createDataFrame([("T1",)], "k string"), "k")) == set()
    assert names(keys.may_hold(index, spark.createDataFrame([("Z",)], "k string"), "k")) == set()


def test_strangers_seldom_pass_and_levels_grow(spark):
    """A part of many keys has more blocks, numbers of another width mean the same, and few keys that aren't there pass."""
    many = spark.range(0, 200_000, 2).select("id", F.when(F.col("id") < 150_000, "a").otherwise("b").alias("p"))
    index = keys.summaries(many, "id", F.col("p")).cache()
    levels = {r["held_in"]: r["level"] for r in index.select("held_in", "level").distinct().collect()}
    assert levels == {"a": 12, "b": 10}
    odd = spark.range(1, 100_000, 2).select(F.col("id").cast("int").alias("k"))
    assert names(keys.may_hold(index, spark.createDataFrame([(150_002,)], "k int"), "k")) == {"b"}
    assert names(keys.may_hold(index, spark.createDataFrame([(2,), (4,)], "k int"), "k")) == {"a"}
    # each stranger as a part of its own: how many of 50,000 pass
    block = keys._block(F.col("k").cast("long"), F.lit(12))
    hit = F.lit(True)
    for n, mask in enumerate(keys._masks(F.col("k").cast("long"))):
        hit = hit & (F.col(f"w{n}").bitwiseAND(mask) != 0)
    passed = odd.withColumn("block", block).join(index.where("held_in = 'a'"), "block").where(hit).count()
    assert passed < 50_000 / 1_000


def test_bounds_reach_the_scan(spark, tmp_path, capsys):
    """Summaries of parts that end before the records begin aren't read."""
    keys.summaries(spark.range(1000), "id", F.lit("old")).write.parquet(f"{tmp_path}/i")
    near = keys.may_hold(spark.read.parquet(f"{tmp_path}/i"), spark.createDataFrame([(900,)], "id long"), "id")
    near.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(last_key,900)" in plan and "LessThanOrEqual(first_key,900)" in plan
