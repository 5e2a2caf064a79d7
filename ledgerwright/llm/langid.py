"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, small_batches

#: Labelled rows that a model is fitted on at most; the sample is spread over the languages.
MAX_ROWS = 3000
#: Languages that a model tells apart at most; of more values those with the most rows, then the first by name.
MAX_LANGUAGES = 512
BUCKETS = 1 << 13
DIMENSIONS = 16
GRAMS = (1, 2, 3, 4)
CHUNK_CHARS = 1_000_000
#: Gradient steps at least, however few the rows.
LEAST_STEPS = 400
#: Share of rightly labelled documents that the rejection threshold may cost on calibration rows.
REJECTED_SHARE = 0.002
UNDETERMINED = "und"


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word index) of the character n-grams of <word>, of all words at once."""
    text = "<" + "><".join(words) + ">" if words else ""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), length)
    buckets, owners = [], []
    for n in GRAMS:
        if len(code) < n:
            break
        h = np.full(len(code) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ code[k : len(code) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        inside = word[: len(h)] == word[n - 1 :]
        buckets.append((h[inside] >> np.uint64(11)).astype(np.int64) % BUCKETS)
        owners.append(word[: len(h)][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A whole text's buckets and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    words = (text or "").lower().split()
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    often = np.bincount(ids, minlength=len(number))
    bucket, owner = subwords(list(number))
    np.add.at(counts, bucket, often[owner])
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass(frozen=True)
class LanguageModel:
    """logits: a row for each bucket, a column for each language. accept: the least score to trust."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    accept: float

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability of each text; equal logits go to the first language."""
        out, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held > CHUNK_CHARS or i == len(texts) - 1:
                self._score(texts, start, i + 1, out, best)
                start, held = i + 1, 0
        return out, best

    def _score(self, texts: list, start: int, end: int, out: list, best: np.ndarray) -> None:
        if not self.languages:
            return
        number: dict[str, int] = {}
        words = [(t or "").lower().split() for t in texts[start:end]]
        ids = np.array([number.setdefault(w, len(number)) for ws in words for w in ws], np.int64)
        bucket, owner = subwords(list(number))
        doc = np.repeat(np.arange(end - start), [len(ws) for ws in words])
        grams = np.bincount(owner, minlength=len(number)).astype(float)
        total = np.bincount(doc, grams[ids], end - start)
        z = np.empty((end - start, len(self.languages)))
        for k in range(len(self.languages)):
            of_word = np.bincount(owner, self.logits[bucket, k], len(number))
            z[:, k] = np.bincount(doc, of_word[ids], end - start) / np.maximum(total, 1) + self.bias[k]
        p = softmax(z * self.temperature)
        top = p.argmax(1)
        for i in range(end - start):
            text = texts[start + i]
            if text is not None and letters(text):
                out[start + i], best[start + i] = self.languages[top[i]], p[i, top[i]]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 30, rate: float = 2.0) -> LanguageModel:
    """Stochastic gradient descent over shuffled batches; a fifth of the rows calibrates.

    A document is the mean of its subwords' embeddings. Calibration picks the temperature of
    least log loss, and a threshold that all but REJECTED_SHARE of those rows reach, never
    above one half. No rows give a model that answers `und`; one language always scores 1.
    """
    languages = tuple(sorted(set(labels)))
    k = len(languages)
    if not k:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    y = np.searchsorted(np.array(languages), np.array(labels))
    rng = np.random.default_rng(7)
    order = rng.permutation(len(y))
    held = order[: len(y) // 5] if len(y) >= 50 else order
    seen = order[len(y) // 5 :] if len(y) >= 50 else order
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    out, bias = rng.normal(0, 0.1, (DIMENSIONS, k)), np.zeros(k)

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS))
        for i, r in enumerate(rows):
            x[i, bags[r][0]] = bags[r][1]
        return x / np.maximum(x.sum(1, keepdims=True), 1)

    batches = max(1, len(seen) // 64)
    epochs = max(epochs, -(-LEAST_STEPS // batches))  # few rows are seen more often
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(seen), batches):
            x = dense(rows)
            h = x @ embed
            g = softmax(h @ out + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            back = g @ out.T
            out -= step * (h.T @ g)
            bias -= step * g.sum(0)
            # rare subwords learn as fast as frequent ones: documents hold about a thousand each
            embed -= step * 100 * (x.T @ back)
    logits = embed @ out
    z = np.concatenate([dense(c) @ logits for c in np.array_split(held, max(1, len(held) // 256))]) + bias
    true = (np.arange(len(held)), y[held])
    losses = {t: -np.log(np.maximum(softmax(z * t)[true], 1e-12)).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0)}
    temperature = min(losses, key=losses.get)
    p = softmax(z * temperature)
    right = p.max(1)[p.argmax(1) == y[held]]
    accept = min(0.5, float(np.quantile(right, REJECTED_SHARE))) if len(right) else 0.0
    return LanguageModel(languages, logits, bias, temperature, accept)


def train(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> LanguageModel:
    """A model from a sample of max_rows rows with a language, spread evenly over languages.

    Rows are chosen by a hash of their id, so a rerun chooses the same; their whole texts are
    reduced to hashed counts where they are read, and only those counts (at most BUCKETS a row)
    come to the driver. Rows without id, language or text are not learned from, nor are those of
    other languages than the MAX_LANGUAGES with the most rows.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return fit([], [])
    quota = 1.2 * max_rows / len(counts)
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, float(min(1, quota / n)))]), F.col("lang"))
    place = F.xxhash64(F.col("id").cast("string"))

    @F.pandas_udf("at array<int>, n array<int>")
    def bags(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([bag(t) for t in text], columns=["at", "n"])

    sample = (
        rows.withColumn("place", place)
        .where((F.pmod(F.col("place"), F.lit(1_000_003)) / 1_000_003.0) < share)
        .select("id", "place", "lang", bags("text").alias("bag"))
        .orderBy("place", "id")
        .limit(max_rows)
        .select("lang", "bag.at", "bag.n")
        .toArrow()
    )
    at, n = ([x.values.to_numpy() for x in sample[c]] for c in ("at", "n"))
    return fit(list(zip(at, n, strict=True)), sample["lang"].to_pylist())


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with `lang_pred`, `score` and `accepted` (columns of these names are replaced).

    Only the text is read, whole. Null texts and texts without a letter (empty ones too) get
    `und`, score 0, and are not accepted; so are scores under the model's threshold. Rows are
    scored each for itself and none is moved; the model that goes to each task has
    BUCKETS x languages numbers. Very long texts are scored by all their subwords, in chunks; of languages
    of one score the first by name counts. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def scored(text: pd.Series) -> pd.DataFrame:
        lang, score = model.score([x if isinstance(x, str) else None for x in text])
        return pd.DataFrame({"lang_pred": lang, "score": score})

    own = docs.drop(*[c for c in ("lang_pred", "score", "accepted", "lang_scored") if c != text_col])
    whole = own.withColumn("lang_scored", scored(F.col(text_col).cast("string")))
    accepted = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= model.accept)
    return whole.select(*own.columns, "lang_scored.*").withColumn("accepted", accepted)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 4, is 2 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


by_value(__name__)
