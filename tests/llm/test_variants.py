import random
import zlib

import pytest
from ledgerwright.llm import variants
from ledgerwright.llm.queries import queries


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    near = {w: [v for v in counts if v != w and one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def grouped(spark, rows):
    out = variants.grouped(spark.createDataFrame(rows, "word string, n long")).collect()
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}


def words(seed, alphabet, size):
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 9))) for _ in range(size)]
    for w in list(base):
        i, c = r.randrange(len(w)), r.choice(alphabet)
        base += [w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]]
    return {w: r.choice([1, 2, 9, 10, 20, 21, 300, 4000]) for w in base}


@pytest.mark.parametrize("alphabet", ["ab", "abcdéÿ", "etaoinsé÷×", "жя漢字𝒳a"])
def test_equals_brute_force(spark, alphabet):
    counts = words(len(alphabet), alphabet, 120)
    assert grouped(spark, list(counts.items())) == brute(counts)


def test_buckets_in_pieces(spark, monkeypatch):
    """Buckets that hold a large share of all words are compared piece against piece; no pair is lost or found twice."""
    monkeypatch.setattr(variants, "BUCKET", 5)
    monkeypatch.setattr(variants, "CELLS", 50)
    counts = words(7, "abc", 150)
    assert grouped(spark, list(counts.items())) == brute(counts)


def test_edges(spark):
    assert grouped(spark, []) == {}
    assert grouped(spark, [(None, 3), ("ab", None), ("ab", 2)]) == {"ab": (None, "ab", 2, 0, None)}
    long = "x" * 50_000
    out = grouped(spark, [(long, 1), (long + "y", 10), ("x" * 24_999 + "z" + "x" * 25_000, 100), ("", 1), ("q", 10)])
    assert out[long][0] == "x" * 24_999 + "z" + "x" * 25_000 and out[long][3] == 2
    assert out[""] == ("q", "q", 1, 1, 10)


def test_ties_and_chains(spark):
    # a tie goes to the smaller word; forms are followed to the last
    counts = {"aaaa": 1, "aaab": 10, "aaac": 10, "aabb": 100, "abbb": 1000}
    assert grouped(spark, list(counts.items())) == brute(counts)
    assert grouped(spark, list(counts.items()))["aaaa"][:2] == ("aaab", "abbb")


def test_query_on_odd_documents(spark, tmp_path):
    text = "Straßenbahn Strassenbahn straßenbahn Straenbahn " * 30
    rows = [(1, text, "x"), (1, text, "x"), (None, None, "x"), (2, "", "x"), (None, text.upper(), "x"), (3, "z" * 30_000 + " " + "z" * 30_000, "x")] + [(k, text, "y") for k in range(10, 60)]
    spark.createDataFrame(rows, "doc_id long, text string, word string").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries()["op11_spelling_variants"](spark, str(tmp_path)).collect()

    counts = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t, _ in rows:
        for run in (t or "").translate(low).split():
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            w = run[:k] + run[k + 1 :] if h % 31 == 0 else run
            counts[w] = counts.get(w, 0) + 1
    want = brute({w: n for w, n in counts.items() if n >= 2 and len(w) >= 7})
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out} == want
