"""Split JSON files against a walk over the whole text that a test can afford."""

import json
import random
import re

import pytest
from ledgerwright.sources import json_scan, readers


def plain(text):
    """(records, lost, broken) of a text, by trying every opening brace from left to right."""
    try:
        return [json.dumps(r, sort_keys=True, ensure_ascii=False) for r in json.loads(text)], [], False
    except json.JSONDecodeError:
        pass
    records, lost, done = [], [], 0
    braces = [m.start() for m in re.finditer("{", text)]
    for k, brace in enumerate(braces):
        if brace < done:
            continue
        if junk := re.sub(r"[\s,\[\]]", "", text[done:brace]):
            lost.append(text[done:brace].strip())
            assert junk
        upto = braces[k + 1] if k + 1 < len(braces) else len(text)
        try:
            value, done = json.JSONDecoder().raw_decode(text, brace)
            records.append(json.dumps(value, sort_keys=True, ensure_ascii=False))
        except json.JSONDecodeError:
            lost.append(text[brace:upto].strip())
            done = upto
    return records, lost, True


def some_object(r, depth=0):
    value = lambda: r.choice([1, None, "x", 'a "q" \\ {', "}, {", "é漢", [1, {"k": "]"}], 2.5, True])
    return {f"k{i}": some_object(r, depth + 1) if depth < 2 and r.random() < 0.3 else value() for i in range(r.randrange(4))}


def some_text(r, broken):
    text = json.dumps([some_object(r) for _ in range(r.randrange(1, 60))], ensure_ascii=False, indent=r.choice([None, 1]))
    for _ in range(r.randrange(1, 6) if broken else 0):
        at = r.randrange(max(1, len(text)))
        text = r.choice([text[:at] + text[at + 1 :], text[:at] + r.choice('{}[]",:x\\\n') + text[at:], text[: max(2, at)], text[:at] + text[at + 7 :]])
    return text


def scanned(spark, path):
    scan = json_scan.Scan(spark, str(path))
    rows = scan.rows().orderBy("_pos").collect()
    return [r["_raw"] for r in rows if r["_raw"] is not None], [r["_lost"] for r in rows if r["_raw"] is None], not scan.sound


def test_one_walk():
    r = random.Random(3)
    for k in range(4000):
        text = some_text(r, k % 4 > 0)
        w = json_scan.walk(text)
        want = plain(text)
        assert ([x for x, _ in w.rows if x is not None], [x for _, x in w.rows if x is not None], not w.sound) == want, text


def in_chunks(text, size, ahead):
    """What Scan does, on one text: chunks from walk to walk."""
    cuts = [m.start() for m in re.finditer("{", text)]
    starts = [0]
    for c in cuts:
        if c - starts[-1] >= size:
            starts.append(c)
    chunks = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
    entry, rows, sound = 0, [], True
    for k, chunk in enumerate(chunks):
        rest, more = "".join(chunks[k + 1 :]), ahead
        while True:
            w = json_scan.walk(chunk, rest[:more], entry, k == 0, k == len(chunks) - 1, more >= len(rest))
            if not w.short:
                break
            more *= 4
        rows, sound, entry = rows + w.rows, sound and w.sound, max(0, w.onward)
    return [x for x, _ in rows if x is not None], [x for _, x in rows if x is not None], not sound


@pytest.mark.parametrize(("size", "ahead"), [(1, 1), (20, 5), (200, 64)])
def test_walks_of_chunks_add_up(size, ahead):
    r = random.Random(size)
    for k in range(1500):
        text = some_text(r, k % 4 > 0)
        assert in_chunks(text, size, ahead) == plain(text), text


@pytest.mark.parametrize("broken", [False, True])
def test_files_in_splits(spark, tmp_path, monkeypatch, broken):
    monkeypatch.setattr(json_scan, "CHUNK", 300)
    monkeypatch.setattr(json_scan, "AHEAD", 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        r = random.Random(9)
        for k in range(4):
            text = some_text(r, broken)
            (tmp_path / f"{k}.json").write_text(text)
            assert scanned(spark, tmp_path / f"{k}.json") == plain(text), text
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("text", ["[]", " [ ] ", "[", "", "x", "{", '[{"a": 1} {"a": 2}]', '[{"a": 1}, {"b": ', '[{"a": 1}, {', '{"a": 1}{"b": 2}', '[{"a": 1}]]'])
def test_edges(spark, tmp_path, text):
    (tmp_path / "f.json").write_text(text)
    records, lost, broken = scanned(spark, tmp_path / "f.json")
    if text:
        assert (records, lost, broken) == plain(text)
    else:
        assert (records, lost) == ([], [])


def test_columns(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"a": 1, "b": null} {"a": {"c": 2}}, junk {"b": "x"}]')
    source = readers.open_source(spark, str(tmp_path / "f.json"), ["a", "b"])
    rows = source.rows.orderBy("_pos").collect()
    assert source.broken and [(r["a"], r["b"], r["_lost"]) for r in rows] == [("1", None, None), ('{"c":2}', None, None), (None, None, ", junk"), (None, "x", None)]
