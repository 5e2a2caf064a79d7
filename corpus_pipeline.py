"""A corpus pipeline: quality rules, language ID, near-duplicates, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of documents, of whatever names and as they are; the last adds the
pieces' ids to what identifies a row.

Null and empty texts have no words, so the first stage drops them; a stage that is given them drops
them too (language ID), keeps them (near-duplicates: linked with nothing), takes them as of no size
(mixing), or gives them no pieces. Texts of any length are worked on whole. Repeated rows are judged each for
itself; of equal texts the smallest id stays. Empty tables give empty results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from ledgerwright.llm import langid, mixing, neardup, pieces, quality
from ledgerwright.llm.common import checkpoint_folder, drop_folder
from ledgerwright.llm.queries import PIECE_MODEL
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The language model and the pieces have no SQL; tests hold run() against a plain version.
ORACLE_SQL: str | None = None
SIMILARITY = 0.8


def judged(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): documents with their own columns out of the way of those that a judgement adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the latest policy of quality rules."""
    return quality.ledger(judged(docs)).where(quality.passes()).select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a model fitted on these documents' labels tells with enough certainty."""
    model = langid.train(docs.select("doc_id", "text", "lang").where(~langid.held_out(F.col("doc_id"))))
    return langid.predict(judged(docs), model).where("accepted").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return neardup.drop_near_duplicates(docs, threshold=SIMILARITY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by sources' weights; a document that is taken several times has several rows."""
    sized = judged(docs).select("row", "doc_id", F.col("row.source").alias("source"), mixing.word_count(F.col("text")).alias("size"))
    return mixing.take(sized).select("row.*")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces, instead of its text."""
    encoded = pieces.encode(docs, pieces.load(spark, PIECE_MODEL))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("language ID", keep_known_languages),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("SentencePiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again.

    A stage's folder is deleted when the next one is written, so one lies there while a stage
    works, and that of the last but one at the end, as the result reads it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                drop_folder(spark, f"{folder}/{k - 1}")
    return docs
