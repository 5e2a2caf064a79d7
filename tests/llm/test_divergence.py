import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from ledgerwright.llm import divergence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))) for text, lang, source in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        found = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in found.items() if n >= divergence.LEAST_DOCUMENTS]
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, c in counts.items():
            far = [(sum(f(share(c, t), share(o, t)) for t in kept), other) for other, o in counts.items() if other != s]
            near = [(f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found_here, most in (("pair", far, None), ("term", near, 10)):
                for k, (value, item) in enumerate(sorted(found_here, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out[lang, s, part, k] = (item, value)
    return out


def audited(spark, rows, more=""):
    docs = spark.createDataFrame(rows, "text string, lang string, source string" + more)
    out = divergence.audit(docs).collect()
    assert len({(r["lang"], r["source"], r["part"], r["rank"]) for r in out}) == len(out)
    return {(r["lang"], r["source"], r["part"], r["rank"]): (r["item"], r["value"]) for r in out}


def documents(seed, sources, n=150):
    r = random.Random(seed)
    terms = ["the", "The", "of", "été", "É", "漢字", "a-b", "x1y", "rare", "ÿ", "zz", "_q_", "mid", "𝒳"]
    out = []
    for _ in range(n):
        weights = [r.random() ** 3 for _ in terms]
        out.append((" ".join(r.choices(terms, weights, k=r.randrange(40))), r.choice(["en", "fr", None, ""]), r.choice(sources)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = documents(seed, [None, "", "web", "Web", "é", "z"])
    assert audited(spark, rows) == brute(rows)


def test_small_pieces(spark, monkeypatch):
    """Tallies that are handed on in pieces add up to the same."""
    monkeypatch.setattr(divergence, "PAIRS", 3)
    monkeypatch.setattr(divergence, "HELD", 4)
    monkeypatch.setattr(divergence, "TERMS", 5)
    monkeypatch.setattr(divergence, "ROWS", 2)
    rows = documents(3, list("abcdefgh"))
    assert audited(spark, rows) == brute(rows)


def test_edges(spark):
    assert audited(spark, []) == {}
    # nothing is kept: all values are 0, and other sources rank by their names
    few = [("word", "en", s) for s in ("b", "a", "c")] + [(None, "en", "d"), ("", "de", None)]
    assert audited(spark, few) == brute(few) and {v for _, v in audited(spark, few).values()} == {0}
    # copies count each, a source without any kept term, a very long text, a clashing column
    rows = [("same words " * 3, "en", "a")] * 12 + [("x " * 60_000, "en", "a"), ("alone", "en", "b"), (None, "en", "c"), ("same " * 30_000, "en", "d")]
    assert audited(spark, rows) == brute(rows)
    clashing = [(*r, 1, "q") for r in rows]
    assert audited(spark, clashing, ", id long, term string") == brute(rows)


def test_shares_are_exact_at_large_counts(spark):
    n, total, v = 9_300_000_000_001, 12_345_678_901_234, 77_777
    got = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(divergence.share("n", "total", "v")).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)


def test_joint_counts():
    lengths = np.array([3, 1, 2])
    found = Counter()
    for (a, b, x, y), times in divergence.joint_counts(np.array([1, 2, 3, 2, 1, 2]), np.array([5, 6, 7, 9, 5, 6]), lengths):
        for row in zip(a.tolist(), b.tolist(), x.tolist(), y.tolist(), times.tolist(), strict=True):
            found[row[:4]] += row[4]
    assert found == {(1, 2, 5, 6): 2, (1, 3, 5, 7): 1, (2, 3, 6, 7): 1}


def test_tasks_hand_on_a_row_for_each_term_of_a_language():
    """Rows shuffled follow a language's terms: sources that share a term share its row, and their counts lie in lists."""
    texts = [(1, 1, "The the été"), (1, 2, "the x1y"), (2, 3, "the"), (1, 1, "the"), (2, 3, ""), (1, 2, "THE,the")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*texts, strict=True)], names=["lang_id", "id", "text"])
    for parts in ([batch], [batch[:0], batch[:2], batch[2:]]):
        rows = [r for out in divergence.counted(iter(parts)) for r in out.to_pylist()]
        found = {(r["lang_id"], r["term"]): (r["docs"], r["ids"], r["counts"]) for r in rows}
        assert len(found) == len(rows)
        assert found == {(1, "the"): (4, [1, 2], [3, 3]), (1, "été"): (1, [1], [1]), (1, "x"): (1, [2], [1]), (1, "y"): (1, [2], [1]), (2, "the"): (1, [3], [1])}


@pytest.mark.parametrize("rows", [1, 3, 50_000])
def test_rows_of_a_term_add_up_over_batches(monkeypatch, rows):
    monkeypatch.setattr(divergence, "ROWS", rows)
    schema = pa.schema({"lang_id": pa.int64(), "term": pa.string(), "docs": pa.int64(), "ids": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())})
    few = [{"lang_id": 1, "term": t, "docs": 9, "ids": [1], "counts": [9]} for t in ("a", "c")]
    many = [{"lang_id": 1, "term": "b", "docs": 1, "ids": [1 + k % 2, 7], "counts": [k, 1]} for k in range(12)]
    other = [{"lang_id": 2, "term": "b", "docs": 10, "ids": [8], "counts": [10]}]
    table = pa.Table.from_pylist([few[0], *many, *other, few[1]], schema)
    for size in (1, 4, 100):
        out = [r for batch in divergence.kept_of(iter(table.to_batches(size))) for r in batch.to_pylist()]
        assert out == [{"lang_id": 1, "term": "b", "n": 78, "ids": [1, 2, 7], "counts": [30, 36, 12]}, {"lang_id": 2, "term": "b", "n": 10, "ids": [8], "counts": [10]}]


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 40, (1 << 62) - 1])
def test_tallies_of_any_width(top):
    """Columns that fit one number together and such that do not."""
    r = random.Random(top)
    rows = [tuple(r.choice([0, 1, top - 1, top]) for _ in range(4)) for _ in range(500)]
    times = [r.randrange(-3, 4) for _ in rows]
    columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
    for weights, expected in ((None, Counter(rows)), (np.array(times), None)):
        if expected is None:
            expected = defaultdict(int)
            for row, t in zip(rows, times, strict=True):
                expected[row] += t
        keys, total = divergence.tallied(columns, weights)
        got = dict(zip(zip(*(k.tolist() for k in keys), strict=True), total.tolist(), strict=True))
        assert got == dict(expected) and len(total) == len(got)
