import random

import numpy as np
from ledgerwright.llm import langid
from pyspark.sql import functions as F


def corpus(n=240):
    r = random.Random(2)
    syllables = {"aa": ["the", "ing", "th", "an"], "bb": ["que", "ción", "los", "ñ"], "cc": ["sch", "ung", "der", "ü"]}
    rows = []
    for i in range(n):
        lang = list(syllables)[i % 3]
        rows.append((i, " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(12, 40))), lang))
    return rows


def test_held_out_accuracy_and_undetermined(spark):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 ... 45", "bb"), (1003, "the thing", None), (None, "the thing", "aa")]
    docs = spark.createDataFrame([(*r, "x") for r in corpus() + odd], "doc_id long, text string, lang string, score string")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    assert model.languages == ("aa", "bb", "cc") and 0 <= model.accept <= 0.5
    out = langid.predict(docs.withColumn("held", langid.held_out(F.col("doc_id"))), model).collect()
    assert len(out) == 245
    right = [r["lang_pred"] == r["lang"] for r in out if r["held"] and r["doc_id"] < 1000]
    assert np.mean(right) > 0.97
    und = {r["doc_id"]: r for r in out if r["doc_id"] in (1000, 1001, 1002)}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 and not r["accepted"] for r in und.values())
    assert all(0 <= r["score"] <= 1 for r in out)
    again = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    assert np.array_equal(again.logits, model.logits)


def test_held_out_is_crc32(spark):
    import zlib

    got = {r[0]: r[1] for r in spark.range(50).select("id", langid.held_out(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


def test_rejects_what_is_no_language(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    model = langid.train(docs)
    texts = [" ".join(x) for x in (["the", "que", "sch"] * 20,)]
    assert model.score(texts)[1][0] < max(model.score([r["text"] for r in docs.limit(20).collect()])[1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert [(r["lang_pred"], r["score"], r["accepted"]) for r in langid.predict(docs, model).collect()] == [("und", 0.0, False)]
    assert langid.predict(docs.where("false"), model).count() == 0
    one = langid.train(spark.createDataFrame([(1, "abc", "xx")], "doc_id long, text string, lang string"))
    assert one.score(["q"]) [0] == ["xx"]


def test_chunks_do_not_matter(monkeypatch):
    rows = corpus(90)
    model = langid.fit([langid.bag(t) for _, t, _ in rows], [x for *_, x in rows])
    texts = [t for _, t, _ in rows] + [None, ""]
    whole = model.score(texts)
    monkeypatch.setattr(langid, "CHUNK_CHARS", 50)
    parts = model.score(texts)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def plain_score(model, text):
    """A model's answer in plain Python: the mean of the logits of all n-grams of all words, softmax, the first best."""
    total, z = 0, [0.0] * len(model.languages)
    for word in text.lower().split():
        whole = f"<{word}>"
        for n in langid.GRAMS:
            for at in range(len(whole) - n + 1):
                h = n
                for c in whole[at : at + n]:
                    h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) % 2**64
                    h ^= h >> 31
                bucket = (h >> 11) % langid.BUCKETS
                total += 1
                z = [x + w for x, w in zip(z, model.logits[bucket], strict=True)]
    z = [(x / max(total, 1) + b) * model.temperature for x, b in zip(z, model.bias, strict=True)]
    e = [np.exp(x - max(z)) for x in z]
    best = max(range(len(e)), key=lambda k: (e[k], -k))
    return model.languages[best], e[best] / sum(e)


def test_query_matches_a_plain_scorer(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    some = sorted((r for r in docs.collect() if r["text"] and any(map(str.isalpha, r["text"]))), key=lambda r: len(r["text"]))
    for r in [*some[:40], *some[40::20], some[-1]]:
        lang, score = plain_score(model, r["text"])
        assert got[r["doc_id"]][0] == lang and abs(got[r["doc_id"]][1] - score) < 1e-6


def test_too_many_languages_leaves_the_commonest(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = [(i, f"{w} {w}{w} {i}", lang) for k, (w, lang, n) in enumerate([("alpha", "a", 30), ("beta", "b", 20), ("gamma", "c", 5)]) for i in range(100 * k, 100 * k + n)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("a", "b")
