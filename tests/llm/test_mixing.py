from collections import defaultdict

from ledgerwright.llm import mixing
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, size long, target string"


def brute_targets(sizes, cycle=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / whole > most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / whole for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


def test_targets_taken_words_and_reruns(spark):
    rows = [(i, None if i % 11 == 0 else f"s{min(i % 37, 7)}", (i * 7919) % 90, "x") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    want = brute_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
    for s, n in taken.items():
        assert abs(n - want[s]) <= 2 * 90
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)


def test_take_repeats_rows_and_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a", 10, "x"), (2, "b", 1000, "y")], SCHEMA)
    counts = {r["doc_id"]: r["count"] for r in mixing.take(docs).groupBy("doc_id").count().collect()}
    assert counts[1] == 3  # its target is capped at three times its size
    assert mixing.take(docs).columns == docs.columns


def test_nulls_ties_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, None, None, None), (None, None, None, None), (1, "", 0, None), (2, "a", 5, None), (2, "a", 5, None)], SCHEMA)
    assert mixing.mix(docs).count() == 5
    none = docs.where("false")
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0


def test_one_id_and_no_id_of_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "a" if i % 2 else "b", 8, "x") for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"mix_hash": F.lit("own"), "copy": F.col("target")})
    out = mixing.mix(docs)
    taken = {r["source"]: (r["n"], r["t"]) for r in out.groupBy("source").agg(F.sum("copies").alias("n"), (F.first("target") / 8).alias("t")).collect()}
    assert all(abs(n - t) <= 1 for n, t in taken.values())
    assert out.where("mix_hash = 'own' AND copy = 'x'").count() == 600
    assert mixing.take(docs).columns == docs.columns


def test_word_count(spark):
    df = spark.createDataFrame([("a b c\x0b\nd",), ("",), (None,), (" \t",)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == [3, 0, 0, 0]
