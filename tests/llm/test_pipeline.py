"""The pipeline against a plain version of each stage, in Python over all rows."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from ledgerwright.llm import quality
from ledgerwright.llm.queries import PIECE_MODEL
from pyspark.sql import functions as F

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, seen[-1], sf).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_quality_stage(stages):
    from tests.llm.test_quality import brute

    def keep(text):
        n, chars, symbols, lines, dup, repeat = brute(text)
        return n >= 10 and 100 * repeat <= 20 * n and 100 * symbols <= 10 * chars and 100 * dup <= 60 * lines and 2 * n <= chars <= 15 * n

    want = sorted([tuple(r) for r in stages[0].collect() if len(r["text"]) < 6000 and keep(r["text"])], key=str)
    assert [r for r in rows(stages[1]) if len(r[1]) < 6000] == want
    assert quality.LATEST == 3


def linear_brute(text):
    """tests.llm.test_quality.brute with a dictionary of windows, for texts of any length."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("chunk", [quality.CHUNK_WORDS, 2000])
def test_quality_stage_on_texts_of_all_lengths(spark, sf, monkeypatch, chunk):
    """Chunk borders fall between long texts as well."""
    monkeypatch.setattr(quality, "CHUNK_WORDS", chunk)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = [r["text"] for r in docs.collect()]
    twice = max(some, key=len)
    docs = docs.unionByName(docs.where(F.length("text") == len(twice)).limit(1).withColumn("text", F.concat_ws("\n", "text", "text")))

    def keep(text):
        n, chars, symbols, lines, dup, repeat = linear_brute(text)
        return n >= 10 and 100 * repeat <= 20 * n and 100 * symbols <= 10 * chars and 100 * dup <= 60 * lines and 2 * n <= chars <= 15 * n

    all_rows = rows(docs)
    want = [r for r in all_rows if keep(r[1])]
    assert rows(corpus_pipeline.keep_good(spark, docs, sf)) == want
    long = [keep(r[1]) for r in all_rows if len(r[1]) >= 6000]
    assert any(long) and not all(long)


def test_language_stage_keeps_clean_documents(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(after) <= set(before) and len(after) > 0.97 * len(before)


def test_near_copies_stage(stages):
    from tests.llm.test_neardup import brute

    texts = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    kept = {i for i, (_, _, k) in brute(texts, corpus_pipeline.SIMILARITY).items() if k}
    assert {r[0] for r in stages[3].select("doc_id").collect()} == kept


def test_mixing_stage(stages):
    from tests.llm.test_mixing import brute_targets

    words = {r["doc_id"]: len(r["text"].encode().split()) for r in stages[3].collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in stages[3].collect():
        sizes[r["source"]] += words[r["doc_id"]]
    copies = Counter(r["doc_id"] for r in stages[4].collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(words)
    for r in stages[3].collect():
        taken[r["source"]] += copies[r["doc_id"]] * words[r["doc_id"]]
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= 2 * max(words.values())


def test_pieces_stage(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    out = stages[5].collect()
    assert len(out) == stages[4].count()
    want = dict(zip(texts, library.encode(list(texts.values())), strict=True))
    assert all(list(r["ids"]) == want[r["doc_id"]] and r["n_pieces"] == len(r["ids"]) for r in out)


def test_run_gives_the_stages_rows(spark, sf, stages):
    assert rows(corpus_pipeline.run(spark, sf)) == rows(stages[5])


def test_stages_keep_all_columns(spark, sf, stages):
    """Columns whose names stages use themselves, or that need quotes, come through as they were."""
    names = ["n_words", "failed_rules", "score", "accepted", "lang_pred", "size", "copies", "near_gone", "near_id", "row", "a.b", "whole"]
    docs = stages[0]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, -F.col("doc_id") - k)
    for (title, stage), plain in zip(corpus_pipeline.STAGES[:-1], stages[1:], strict=False):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, title
        got = rows(out)
        assert [r[:5] for r in got] == [tuple(r) for r in sorted((tuple(r) for r in plain.collect()), key=lambda r: str((*r, *(-r[0] - k for k in range(len(names))))))], title
        assert all(r[5:] == tuple(-r[0] - k for k in range(len(names))) for r in got), title
        docs = spark.createDataFrame(got, docs.schema)
    assert corpus_pipeline.to_pieces(spark, docs, sf).columns == ["doc_id", "lang", "source", "n_pieces", "ids"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0
