import random
import re

from ledgerwright.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(1)
    out = [None, "", " \n\t", "a", "a b c d e a b c d e", "x\n" * 30, "é ü #*$\n\n|<>\r\nq", "w " * 5000]
    for _ in range(150):
        out.append("".join(r.choice(["a", "b", "ab", "#", "é"]) + r.choice([" ", "\n", "  ", "\x0b"]) for _ in range(r.randrange(60))))
    return out


def test_measures_match_brute_force():
    some = texts()
    got = quality.measure_texts(some)
    for row, t in zip(got.tolist(), some, strict=True):
        if t and len(t) > 5000:
            assert row[0] == 5000 and row[5] == 5000
        else:
            assert tuple(row) == brute(t)


def test_chunks_do_not_matter(monkeypatch):
    some = texts()
    whole = quality.measure_texts(some)
    monkeypatch.setattr(quality, "CHUNK_WORDS", 7)
    assert (quality.measure_texts(some) == whole).all()


def test_ledger_policies_and_ablation(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good, 9), (2, "few words", 9), (3, "same " * 50, 9), (4, " ".join(f"w{i}###" for i in range(30)), 9), (5, None, 9), (5, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    out = quality.ledger(docs)
    assert out.columns.count("n_words") == 1
    failed = {r["doc_id"]: r["failed_rules"] for r in out.collect()}
    assert failed[1] == 0 and failed[2] == failed[5] == quality.BIT["few_words"]
    assert failed[3] & quality.BIT["repeated_words"] and failed[4] == quality.BIT["many_symbols"]
    assert out.where(quality.passes(1)).count() == 2 and out.where(quality.passes()).count() == 1
    ablation = {r["rule"]: (r["failing"], r["only_failing"]) for r in quality.ablation(out).collect()}
    assert ablation["few_words"] == (3, 3) and ablation["many_symbols"] == (1, 1)
    assert quality.ledger(docs.where("false")).count() == 0
