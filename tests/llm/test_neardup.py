import random

import numpy as np
import pytest
from ledgerwright.llm import neardup, pairing


def brute(texts, threshold):
    def shingles(t):
        w = (t or "").encode().translate(neardup.LOWER).split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= round(100 * threshold) * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for g in range(12):
        base = [r.choice(vocabulary) for _ in range(r.randrange(30, 160))]
        for _ in range(r.randrange(1, 12)):
            copy = list(base)
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts[len(texts) * 3 % 1009] = " ".join(copy) if r.random() < 0.8 else " ".join(copy).upper() + " \n"
    texts |= {2000: None, 2001: "", 2002: " \t\n", 2003: "one two", 2004: "ONE  two", 2005: "one two three"}
    return texts


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_components_match_brute_force(spark, threshold):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = neardup.near_duplicates(docs, threshold=threshold).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out} == brute(texts, threshold)


def test_regions_that_are_too_large(spark, monkeypatch):
    monkeypatch.setattr(pairing, "REGION", 4)
    monkeypatch.setattr(neardup, "REGION", 4)
    monkeypatch.setattr(pairing, "LEAVES", 3)
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = neardup.near_duplicates(docs, threshold=0.85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out} == brute(texts, 0.85)


def test_large_star_around_the_largest_id(spark):
    """Every copy links with the original alone, so one lost link would split a document off."""
    r = random.Random(9)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(1000):
        copy = list(base)
        for third in range(3):
            copy[third * 66 + r.randrange(5, 61)] = f"x{i}.{third}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame([*rows, (1000, " ".join(base))], "doc_id long, text string")
    out = neardup.near_duplicates(docs, threshold=0.85)
    assert out.where("component_id <> 0").count() == 0 and out.where("kept").count() == 1


def matched(texts, threshold):
    """Roots by brute force: shared shingles of each document with all others, by lists of the documents of a shingle."""
    sets = neardup.shingle_sets(texts)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    held = np.split(owner[np.argsort(token, kind="stable")], np.cumsum(np.bincount(token))[:-1])
    own = np.split(token, np.cumsum(size)[:-1])
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        common = np.bincount(np.concatenate([held[t] for t in own[i]]), minlength=len(texts))
        for j in np.flatnonzero(100 * common >= round(100 * threshold) * (size[i] + size - common)):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_links_among_boilerplate(spark):
    """Documents that share most of their words without linking, and planted pairs just above the threshold among them."""
    r = random.Random(21)
    word = lambda: f"w{r.randrange(10**9)}"
    rows = []
    for background, of in ((0.5, 500), (0.7, 700), (0.8, 900)):
        shared = [word() for _ in range(140)]
        own = round(140 * (1 - background) / (2 * background))
        for _ in range(of // 2):
            text = [*shared, *(word() for _ in range(own + r.randrange(3)))]
            rows.append(text)
            near = list(text)
            if r.random() < 0.5:  # one word changes five shingles
                near[-3], near[20] = word(), word()
            else:
                near[-own // 2 :] = [word() for _ in range(own // 2)]
            rows.append(near)
    r.shuffle(rows)
    texts = [" ".join(x) for x in rows]
    want = matched(texts, 0.85)
    assert 300 < len(set(want)) < len(texts) - 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(docs, threshold=0.85).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "A b c d e f"), (7, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    out = {(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()}
    assert out == {(None, None, True), (5, 5, True), (6, 5, False), (7, 7, True)}
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 4
    assert neardup.near_duplicates(docs.where("false")).count() == 0
