"""Very long texts, ties and empty tables where the operators' docstrings state what they give."""

import numpy as np
from ledgerwright.llm import grades, langid, licenses, neardup, sharding


def test_long_texts_are_told_as_short_ones():
    model = langid.fit([langid.bag("the thing than"), langid.bag("que los cion")], ["aa", "bb"])
    once, many = (model.score([x])[1][0] for x in ("the thing than", "the thing than " * 150_000))
    assert model.score(["the thing than " * 150_000])[0] == ["aa"] and abs(once - many) < 1e-6


def test_languages_of_one_score_give_the_first():
    model = langid.LanguageModel(("aa", "bb"), np.zeros((langid.BUCKETS, 2)), np.zeros(2), 1.0, 0.0)
    assert [list(x) for x in model.score(["word", None])] == [["aa", "und"], [0.5, 0.0]]


def test_a_notice_at_the_end_of_a_long_text(spark):
    texts = [("a/1", "word " * 300_000 + "\nReleased under the MIT License."), ("a/2", "word " * 300_000)]
    got = {r["path"]: r["own_license"] for r in licenses.scan(spark.createDataFrame(texts, "path string, text string")).collect()}
    assert got == {"a/1": "MIT", "a/2": None}


def test_long_copies_are_linked(spark):
    words = [f"w{k}" for k in range(120_000)]
    other = words[:60_000] + ["x"] + words[60_001:]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(f"v{k}" for k in range(120_000)))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.85).collect()}
    assert got == {1: (119_996, 1), 2: (119_996, 1), 3: (119_996, 3)}


def test_nothing_to_place_or_grade(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(docs, 3).count() == 0
    assert grades.grade(docs, grades.train(docs, spark.createDataFrame([], "doc_id long, grade int"), 3)).count() == 0
    placed = sharding.assign_shards(spark.createDataFrame([(1, "q" * 2_000_000), (1, "")], "doc_id long, text string"), 3)
    assert placed.select("shard").distinct().count() == 1
