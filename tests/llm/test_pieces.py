import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerwright.llm import pieces
from ledgerwright.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary here")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    with open(PIECE_MODEL, "rb") as f:
        return pieces.PieceModel.parse(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


TEXT = st.text(st.one_of(st.sampled_from("aabcdeinorst  \n.,'"), st.characters(exclude_categories=["Cs"])), max_size=60)


def test_documents_match_the_library(spark, sf, model, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = pieces.decode(pieces.encode(docs, model), model).collect()
    assert [list(r["ids"]) for r in rows] == library.encode([r["text"] for r in rows])
    assert all(r["decoded"] == r["text"] for r in rows)


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_any_text_matches_the_library(model, library, text):
    ids = model.encode([text])[0]
    assert ids.tolist() == library.encode(text)
    assert model.decode([ids]) == [library.decode(ids.tolist())]
    if pieces.SPACE not in text:
        assert model.decode([ids]) == [text]


def test_long_words_and_spaces(model, library):
    some = ["a" * 2500, " " * 70 + "x", "é" * 90, "", "ab" * 999 + " " + "x\n" * 50]
    assert [x.tolist() for x in model.encode(some)] == library.encode(some)


def test_unigram_scores(model):
    """The same search with scores: it finds the best sum, as trying all splits does."""
    other = pieces.PieceModel(["<unk>", "▁", "a", "b", "ab", "ba", "aba", "▁a"], pieces.np.array([0, -2.0, -1.5, -1.7, -2.2, -2.6, -3.1, -2.4]), pieces.np.array([2, 1, 1, 1, 1, 1, 1, 1]), pieces.UNIGRAM, True, False, 0)

    def best(w):
        table = {0: (0.0, [])}
        for i in range(1, len(w) + 1):
            found = [(table[i - n][0] + other.scores[other.id_of[w[i - n : i]]], [*table[i - n][1], other.id_of[w[i - n : i]]]) for n in (1, 2, 3) if n <= i and w[i - n : i] in other.id_of]
            table[i] = max(found)
        return table[len(w)][0]

    for w in ("abab", "aabba", "b", "ababababa"):
        ids = other.encode([w])[0]
        assert abs(sum(other.scores[ids]) - best("▁" + w)) < 1e-9
    assert other.encode(["xya"])[0].tolist() == [1, 0, 2]


def test_nulls_empty_and_clashing_names(spark, model):
    df = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (3, "hi", "q")], "doc_id long, text string, ids string")
    out = {r["doc_id"]: (None if r["ids"] is None else len(r["ids"]), r["decoded"]) for r in pieces.decode(pieces.encode(df, model), model).collect()}
    assert out == {1: (None, None), 2: (0, ""), 3: (1, "hi")}
    assert pieces.encode(df.where("false"), model).count() == 0
    assert model.decode([[99_999_999, 5, None]])[0].startswith(" ⁇")
