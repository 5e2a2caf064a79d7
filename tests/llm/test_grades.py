import math
import random

import numpy as np
import xxhash
from ledgerwright.llm import grades


def corpus(n=600):
    r = random.Random(8)
    rows, ratings = [], []
    for i in range(n):
        g = i % 3
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(15, 60))]
        words += [["bad", "worse"], ["middling"], ["good", "fine"]][g] * (1 if r.random() < 0.97 else 0)
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        ratings.append((i, g))
    return rows, ratings


def test_held_out_grades(spark):
    rows, ratings = corpus()
    docs = spark.createDataFrame([(*x, "q") for x in rows], "doc_id long, text string, kept string")
    rated = spark.createDataFrame([x for x in ratings if x[0] % 4] + [(None, 1), (3, 9), (5, None)], "doc_id long, grade int")
    model = grades.train(docs, rated, 3)
    assert model.thresholds[0] < model.thresholds[1]
    out = {r["doc_id"]: r for r in grades.grade(docs, model).collect()}
    means = [np.mean([out[i]["expected_grade"] for i, g in ratings if g == k and i % 4 == 0]) for k in range(3)]
    assert means[0] + 0.3 < means[1] and means[1] + 0.3 < means[2]
    right = [out[i]["kept"] == (g == 2) for i, g in ratings if i % 4 == 0]
    assert np.mean(right) > 0.85
    assert all(0 <= r["tail_probability"] <= 1 for r in out.values())
    assert np.array_equal(grades.train(docs, rated, 3).weights, model.weights)


def test_fit_raises_every_likelihood():
    """Of separable rows; with no weights, each grade is as likely as it is frequent, a third."""
    rows, y = [np.array([300 + g, 400, 500 + i]) for i in range(40) for g in range(3)], np.tile([0, 1, 2], 40)
    model = grades.fit(rows, y, 3)
    z = np.array([model.weights[b].sum() for b in rows])
    tails = np.concatenate([np.ones((120, 1)), grades.sigmoid(z[:, None] - model.thresholds), np.zeros((120, 1))], 1)
    p = tails[np.arange(120), y] - tails[np.arange(120), y + 1]
    assert (p > 0.5).all()
    # the grade in the middle has no slope; what all rows have and what one row has tells nothing
    assert set(np.flatnonzero(model.weights)) == {300, 302}


def test_chance_gets_no_weight_and_few_rows_keep_the_common_grade():
    r = np.random.default_rng(3)
    for n in (10, 64, 1000):
        rows, y = [np.unique(r.integers(300, 20_000, 200)) for _ in range(n)], np.where(r.random(n) < 0.8, 2, r.integers(0, 2, n))
        model = grades.fit(rows, y, 3)
        assert np.count_nonzero(model.weights) <= 1
        assert grades.sigmoid(-model.thresholds)[1] > 0.5


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = grades.train(docs, none, 3)
    assert grades.grade(docs, model).count() == 3
    assert grades.grade(docs.where("false"), model).count() == 0


def plain_tails(model, text):
    """A model's tail probabilities in plain Python, a word at a time."""
    words = (text or "").lower().split()
    n = max(1, len(words))
    raw = (text or "").encode("utf-8", "surrogatepass")
    own = raw.split()
    chars = sum(len(w.decode("utf-8", "surrogatepass")) for w in own)
    symbols = sum(raw.count(c.encode()) for c in "#*$%&|<>")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    often, inside = {}, set()
    for i in range(len(own) - 4):
        often.setdefault(tuple(own[i : i + 5]), []).append(i)
    for at in often.values():
        if len(at) > 1:
            inside.update(i + k for i in at for k in range(5))
    repeated = (len(lines) - len(set(lines))) / max(1, len(lines))
    buckets = {n.bit_length(), 50 + min(9, int(30 * symbols / max(1, chars))), 100 + min(9, int(10 * len(inside) / n))}
    buckets |= {150 + min(9, int(10 * repeated)), 200 + int(5 * len(set(words)) / n)}
    for w in words:
        w = w.strip(".,;:!?\"'()[]") or w
        for x in (w, *["\x00" + w[:k] for k in (4, 5, 6) if len(w) >= k]):
            buckets.add(grades.MEASURES + xxhash.xxh3_64_intdigest(x) % (grades.BUCKETS - grades.MEASURES))
    z = sum(float(model.weights[b]) for b in buckets)
    return [1 / (1 + math.exp(-max(-40, min(40, z - t)))) for t in model.thresholds]


def test_query_matches_a_plain_scorer(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ratings = labels.selectExpr("doc_id", "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END AS grade")
    model = grades.train(docs, ratings, 3)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in grades.grade(docs.select("doc_id", "text"), model).collect():
        tails = plain_tails(model, texts[r["doc_id"]])
        assert abs(r["expected_grade"] - sum(tails)) < 1e-6 and abs(r["tail_probability"] - tails[-1]) < 1e-6
        assert r["kept"] == (r["tail_probability"] >= 0.5)


def test_very_long_texts_and_ties(spark):
    model = grades.GradeModel(np.linspace(-1, 1, grades.BUCKETS) / 1000, np.array([-0.5, 0.5]))
    long = " ".join(f"w{i % 5000}" for i in range(300_000))
    got = [r["expected_grade"] for r in grades.grade(spark.createDataFrame([(1, long), (2, long), (3, "")], "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert got[0] == got[1] and abs(got[0] - sum(plain_tails(model, long))) < 1e-6 and abs(got[2] - sum(plain_tails(model, ""))) < 1e-6


def test_counts_in_tasks_give_the_fit_on_whole_rows(spark, sf):
    """What Spark counts and leaves out of the rows changes nothing: the weights are those of a fit on all features."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END AS grade")
    got = grades.train(docs, labels, 3)
    first = labels.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    rows = docs.join(first, "doc_id").where("text IS NOT NULL").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").collect()
    bags = [grades.features([r["text"]])[1] for r in rows]
    whole = grades.fit(bags, np.array([r["grade"] for r in rows]), 3)
    assert np.count_nonzero(got.weights) and np.allclose(got.weights, whole.weights) and np.allclose(got.thresholds, whole.thresholds)
