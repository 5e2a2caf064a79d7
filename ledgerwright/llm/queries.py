"""A thin query for each corpus operator, with its contract's columns, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, grades, langid, licenses, mixing, neardup, neardup_vectors, pieces, pii, quality, sharding, urls, variants
from .common import ascii_lower, durable

SHARDS = 64
LINK_DOCUMENTS = 0.85
LINK_VECTORS = 0.9
#: A public tokenizer's vocabulary; a deployment names its own.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The listed hosts and paths, and what becomes of their urls.
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = durable(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    taken = mixing.mix(sized)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op2_sentencepiece(spark: SparkSession, sf_dir: str, path: str = PIECE_MODEL) -> DataFrame:
    model = pieces.load(spark, path)
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    decoded = pieces.decode(encoded, model)
    return decoded.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = sharding.assign_shards(docs, SHARDS)
    return placed.select("doc_id", F.col("shard_slot").cast("long").alias("shard_slot"), "shard")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("failed_rules").bitwiseAND(F.lit(quality.BASE)) != 0
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), quality.passes().alias("kept"), "failed_rules"
    )


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of op4's latest policy does, from the ledger's bitmasks."""
    return quality.ablation(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files <source>/<lang>/<doc_id>.txt.

    One of whose characters at least half are in lines that speak of a licence is a licence file of
    its directory, <source>/<lang>/LICENSE.<doc_id>, and the others there inherit from it.
    """
    docs = table(spark, sf_dir, "documents")
    notices = F.filter(F.split("text", "\n"), lambda line: line.rlike("(?i)licen[cs]e"))
    is_licence = F.coalesce(2 * F.length(F.array_join(notices, "\n")) >= F.greatest(F.length("text"), F.lit(1)), F.lit(False))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    name = F.when(is_licence, F.concat(F.lit("LICENSE."), number)).otherwise(F.concat(number, F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), name)
    found = licenses.scan(docs.select("doc_id", path.alias("path"), "text"))
    return found.select("doc_id", "path", "own_license", F.round("similarity", 6).alias("similarity"), "license", "license_from")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, threshold=LINK_DOCUMENTS)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{rule}', '{action}')" for rule, action in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(rule, action)")
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=LINK_VECTORS)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 of low quality, 1 toxic, 2 good. Documents whose crc32(doc_id) mod 4 is 2 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    rating = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    ratings = labels.where(~langid.held_out(F.col("doc_id"))).select("doc_id", rating.alias("grade"))
    found = grades.grade(docs, grades.train(docs, ratings, 3))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least 7 letters found twice or more, after one letter is struck out of every 31st run or so."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    run = docs.select("id", F.explode(variants.runs(F.col("text"), 7)).alias("run")).select("id", ascii_lower(F.col("run")).alias("run"))
    hashed = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    struck = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, struck).otherwise(F.col("run")).alias("word")).where(F.length("word") >= 7)
    often = durable(words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2"))
    return variants.grouped(often)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    name = lambda s: F.element_at(F.array(*map(F.lit, pii.KINDS)), s["kind"] + 1)
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    sure = found.withColumn("sure", F.filter("spans", lambda s: s["sure"]))
    of_kind = lambda kind: F.filter("sure", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return sure.select("doc_id", *counts, F.sha2(written(F.col("sure")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_sharding": op3_sharding,
        "op4_quality_rules": op4_quality_rules,
        "quality_ablation": quality_ablation,
        "op5_language_id": op5_language_id,
        "op6_license_scans": op6_license_scans,
        "op7_minhash_near_dedup": op7_minhash_near_dedup,
        "op8_url_filters": op8_url_filters,
        "op9_embedding_near_dedup": op9_embedding_near_dedup,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_source_divergence": op12_source_divergence,
        "op13_pii": op13_pii,
    }


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
