"""Quality rules as a bitmask ledger: measure once, then apply and compare policies."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, small_batches

WINDOW = 5
#: Words that are worked on together; a text longer than that stands alone.
CHUNK_WORDS = 200_000
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails` is true; `base` rules are part of every policy."""

    name: str
    fails: str
    base: bool = False


#: The bit of a rule is its place here; append only, as ledgers are stored.
RULES = (
    Rule("few_words", "n_words < 10", base=True),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", base=True),
    Rule("many_symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}
BASE = sum(BIT[r.name] for r in RULES if r.base)
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    1: BASE,
    2: BASE | BIT["many_symbols"] | BIT["repeated_lines"],
    3: BASE | BIT["many_symbols"] | BIT["repeated_lines"] | BIT["long_words"] | BIT["short_words"],
}
LATEST = max(POLICIES)


def repeated_words(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Per document the words that lie in a window of 5 words found twice or more in it.

    Windows are compared exactly: pairs are numbered, then pairs of pairs, then those with the fifth.
    """
    out = np.zeros(docs, np.int64)
    if len(ids) < WINDOW:
        return out
    number = lambda a, b: np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]
    two = number(ids[:-1], ids[1:])
    four = number(two[:-2], two[2:])
    five = number(four[:-1], ids[4:])
    at = np.flatnonzero(doc[:-4] == doc[4:])
    if not len(at):
        return out
    _, which, often = np.unique(five[at] * docs + doc[at], return_inverse=True, return_counts=True)
    found = at[often[which] > 1]
    edge = np.zeros(len(ids) + WINDOW + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge)[: len(ids)] > 0], minlength=docs)


def measure_texts(texts: list[str | None]) -> np.ndarray:
    """The measures of some texts, a row each."""
    out = np.zeros((len(texts), 6), np.int64)
    start = 0
    pending: list[list[bytes]] = []

    def flush(end: int) -> None:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for ws in pending for w in ws], np.int64)
        doc = np.repeat(np.arange(len(pending)), [len(ws) for ws in pending])
        out[start:end, 5] = repeated_words(ids, doc, len(pending))

    held = 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        words = raw.split()
        lines = [x for x in raw.split(b"\n") if x.strip()] if words else []
        blanks = sum(raw.count(BLANKS[k : k + 1]) for k in range(6))
        symbols = sum(raw.count(SYMBOLS[k : k + 1]) for k in range(8))
        out[i, :5] = len(words), (len(text) if text else 0) - blanks, symbols, len(lines), len(lines) - len(set(lines))
        if pending and held + len(words) > CHUNK_WORDS:
            flush(i)
            start, pending, held = i, [], 0
        pending.append(words)
        held += len(words)
    if pending:
        flush(len(texts))
    return out


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the measures and `failed_rules` (columns of these names are replaced).

    Each rule is evaluated once; bit i of failed_rules is set where RULES[i] fails. The text
    is read whole, in one pass, and no row is moved.
    Null and empty texts have no words, so they fail few_words only. Ties and repeated rows
    are measured each for itself; an empty table gives an empty ledger.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(MEASURES)
    def measured(text: pd.Series) -> pd.DataFrame:
        values = measure_texts([x if isinstance(x, str) else None for x in text])
        return pd.DataFrame(values, columns=[f.split()[0] for f in MEASURES.split(", ")])

    names = [f.split()[0] for f in MEASURES.split(", ")]
    bits = sum((F.when(F.expr(r.fails), F.lit(BIT[r.name])).otherwise(0) for r in RULES), F.lit(0).cast("long"))
    own = docs.drop(*[c for c in (*names, "failed_rules", "quality_measured") if c != text_col])
    whole = own.withColumn("quality_measured", measured(F.col(text_col).cast("string")))
    return whole.select(*own.columns, "quality_measured.*").withColumn("failed_rules", bits)


def passes(version: int = LATEST, failed: Column | None = None) -> Column:
    """Whether a row of a ledger passes a policy."""
    return (F.col("failed_rules") if failed is None else failed).bitwiseAND(F.lit(POLICIES[version])) == 0


def ablation(ledger: DataFrame, version: int = LATEST) -> DataFrame:
    """What each rule of a policy does: (rule, failing, only_failing).

    failing: documents that fail the rule. only_failing: documents the policy would keep without
    it. The ledger is reduced to its distinct bitmasks first, at most 2 to the number of rules.
    """
    masks = ledger.groupBy(F.col("failed_rules").bitwiseAND(F.lit(POLICIES[version])).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit")) for r in RULES if BIT[r.name] & POLICIES[version]])
    each = masks.withColumn("r", F.explode(rules)).select("mask", "n", "r.rule", "r.bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_failing"),
    )


by_value(__name__)
