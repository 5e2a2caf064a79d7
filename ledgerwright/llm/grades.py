"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, durable, release, shared, small_batches
from .quality import measure_texts

BUCKETS = 1 << 18
#: The first buckets, which the measures of a text have for themselves: 50 levels of each.
MEASURES = 250
#: Lengths of a word's beginnings, which its inflected and compound forms share.
BEGINNINGS = (4, 5, 6)
#: Rated rows that a model is fitted on at most.
MAX_ROWS = 16000
CHUNK_WORDS = 200_000
EPOCHS = 30
#: Gradient steps at least, so that small samples are fitted too.
LEAST_STEPS = 400
#: Variance of the normal prior of a weight.
PRIOR = 0.3


def word_buckets(word: str) -> list[int]:
    """Buckets of a word without punctuation at its ends and of its beginnings (-1: too short for one)."""
    bare = word.strip(".,;:!?\"'()[]") or word
    parts = [bare] + ["\x00" + bare[:n] if len(bare) >= n else None for n in BEGINNINGS]
    return [-1 if x is None else MEASURES + xxhash.xxh3_64_intdigest(x) % (BUCKETS - MEASURES) for x in parts]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket): the distinct words of each whole text and their beginnings, and its measures.

    Words are lower-cased. All count as one, so a few telling words count as much in a long text
    as in a short one.
    """
    words = [(t or "").lower().split() for t in texts]
    measures = measure_texts(texts)
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in set(ws)], np.int64) for ws in words]
    table = np.array([word_buckets(w) for w in number], np.int64).reshape(-1, 1 + len(BEGINNINGS))
    doc, bucket = [], []
    for i, ws in enumerate(words):
        n = max(1, len(ws))
        m = measures[i]
        levels = (n.bit_length(), int(30 * m[2] / max(1, m[1])), int(10 * m[5] / n), int(10 * m[4] / max(1, m[3])), int(5 * len(ids[i]) / n))
        some = [50 * k + min(49 if k == 0 else 9, x) for k, x in enumerate(levels)]
        got = np.unique(np.append(table[ids[i]].ravel(), some))
        got = got[got >= 0]
        doc.append(np.full(len(got), i))
        bucket.append(got)
    if not doc:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(doc), np.concatenate(bucket).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class GradeModel:
    """Shared weights, and thresholds in rising order between the grades 0, 1, ... .

    P(grade > k) = sigmoid(weights x - thresholds[k]).
    """

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[str | None]) -> np.ndarray:
        out, start, held = np.zeros((len(texts), len(self.thresholds))), 0, 0
        for i, t in enumerate(texts):
            held += len(t or "") // 6
            if held > CHUNK_WORDS or i == len(texts) - 1:
                d, b = features(texts[start : i + 1])
                z = np.bincount(d, self.weights[b], i + 1 - start)
                out[start : i + 1] = sigmoid(z[:, None] - self.thresholds[None, :])
                start, held = i + 1, 0
        return out


def telling(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each bucket tells grades apart beyond chance.

    counts: by bucket and grade, the rows that have the bucket; rows: the rows of each grade.
    By a score test of its weight in the model of thresholds alone: the sum of the residuals of
    the rows that have it, over the root of the sum of their squares, must pass the universal
    bound sqrt(2 ln p) of p tested buckets, for measures and words each. So a bucket needs
    evidence in more than 2 ln p rows; with few rows few weights or none leave zero, and what is
    unknown goes by the thresholds.
    """
    above = np.concatenate([[1.0], 1 - np.cumsum(rows / max(rows.sum(), 1))])
    residual = 1 - above[:-1] - above[1:]  # slope of the log likelihood when a row's links all shift
    squares = counts @ (residual * residual)
    score = np.abs(counts @ residual) / np.sqrt(np.maximum(squares, 1e-12))
    out = np.zeros(BUCKETS, bool)
    for family in (slice(0, MEASURES), slice(MEASURES, BUCKETS)):
        tested = np.count_nonzero(squares[family])
        out[family] = score[family] > np.sqrt(2 * np.log(max(tested, 2)))
    return out


def counted(rows: list[np.ndarray], grades: np.ndarray, levels: int) -> np.ndarray:
    """The rows of each bucket and grade."""
    flat = [np.concatenate([b * levels + g for b, g in zip(rows[k : k + 500], grades[k : k + 500], strict=True)]) for k in range(0, len(rows), 500)]
    return sum((np.bincount(f, minlength=BUCKETS * levels) for f in flat), np.zeros(BUCKETS * levels, np.int64)).reshape(BUCKETS, levels)


def fit(rows: list[np.ndarray], grades: np.ndarray, levels: int, tells: np.ndarray | None = None) -> GradeModel:
    """Adam on the log loss of the cumulative links; thresholds rise as the first plus positive gaps.

    rows: the buckets of each text. Only the weights of telling() buckets are fitted; where these are
    known (`tells`), rows need hold no others.
    """
    if tells is None:
        tells = telling(counted([b.astype(np.int64) for b in rows], grades, levels), np.bincount(grades, minlength=levels))
    used = np.flatnonzero(tells)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    rows = [x[x >= 0] for x in (place[b] for b in rows)]
    rng = np.random.default_rng(5)
    w, first, gaps = np.zeros(len(used)), np.zeros(1), np.zeros(max(0, levels - 2))
    params = [w, first, gaps]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    batches = max(1, len(rows) // 128)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches)) if len(rows) else 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for some in np.array_split(order, batches):
            d = np.repeat(np.arange(len(some)), [len(rows[r]) for r in some])
            b = np.concatenate([rows[r] for r in some])
            theta = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
            z = np.bincount(d, w[b], len(some))
            y = grades[some]
            upper = np.concatenate([np.full((len(some), 1), 1.0), sigmoid(z[:, None] - theta), np.zeros((len(some), 1))], 1)
            at = np.arange(len(some))
            p = np.maximum(upper[at, y] - upper[at, y + 1], 1e-9)
            slope = upper * (1 - upper)
            gz = -(slope[at, y] - slope[at, y + 1]) / p / len(some)
            gt = np.zeros(levels + 1)
            np.add.at(gt, y, slope[at, y] / p / len(some))
            np.add.at(gt, y + 1, -slope[at, y + 1] / p / len(some))
            gt = gt[1:-1]
            grads = [np.bincount(b, gz[d], len(used)) + w / (PRIOR * len(rows)), np.array([gt.sum()]), np.array([gt[k + 1 :].sum() for k in range(levels - 2)]) * np.exp(gaps)]
            step += 1
            rate = 0.05 * (1 - epoch / epochs) + 0.002
            for q, g, (m, s) in zip(params, grads, state, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return GradeModel(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))


def train(docs: DataFrame, ratings: DataFrame, levels: int, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> GradeModel:
    """A model from at most max_rows documents rated (id_col, grade), grade in 0 .. levels - 1.

    The sample is chosen by a hash of the id, so a rerun chooses the same; whole texts are
    reduced to hashed features where they are read, and written to a table of these. To the driver come
    counts, at most BUCKETS x levels, and of each row the buckets that pass telling(), in whatever
    length its text has. Ratings without id or with another grade
    are left out; of several ratings of one document the lowest counts. No rated rows give a
    model that holds every grade to be as likely.
    """
    small_batches(docs.sparkSession)
    place = F.xxhash64(F.col("id").cast("string"))
    rated = ratings.select(F.col(id_col).alias("id"), F.col("grade").cast("int").alias("grade")).where(f"id IS NOT NULL AND grade BETWEEN 0 AND {levels - 1}")
    chosen = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(place, "id").limit(max_rows)

    @F.pandas_udf("array<int>")
    def extracted(text: pd.Series) -> pd.Series:
        d, b = features(list(text))
        edge = np.searchsorted(d, np.arange(len(text) + 1))
        return pd.Series([b[edge[i] : edge[i + 1]] for i in range(len(text))])

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    # max_rows bounds the broadcast
    sample = own.join(F.broadcast(chosen), "id").select("id", "grade", extracted("text").alias("bucket")).orderBy(place, "id").limit(max_rows)
    sample = durable(sample)
    rows, counts = np.zeros(levels, np.int64), np.zeros((BUCKETS, levels), np.int64)
    for r in sample.groupBy("grade").count().collect():
        rows[r["grade"]] = r["count"]
    of_bucket = sample.select("grade", F.explode("bucket").alias("bucket")).groupBy("bucket").agg(*[F.count_if(F.col("grade") == k).alias(f"n{k}") for k in range(levels)]).toArrow()
    counts[of_bucket["bucket"].to_numpy()] = np.stack([of_bucket[f"n{k}"].to_numpy() for k in range(levels)], 1)
    tells = telling(counts, rows)

    @F.pandas_udf("array<int>")
    def left(bucket: pd.Series) -> pd.Series:
        return pd.Series([b[tells[b]] for b in bucket], dtype=object)

    held = sample.select("id", "grade", left("bucket").alias("bucket")).orderBy(place, "id").select("grade", "bucket").toArrow()
    release(sample)
    return fit([b.values.to_numpy() for b in held["bucket"]], held["grade"].to_numpy().astype(np.int64), levels, tells)


def grade(docs: DataFrame, model: GradeModel, *, text_col: str = "text", least: int | None = None, probability: float = 0.5) -> DataFrame:
    """docs with expected_grade, tail_probability and kept (columns of these names are replaced).

    tail_probability is that of a grade of `least` (the best one by default) or more; kept says
    whether it reaches `probability`. Null and empty texts are graded by their lack of words.
    Each whole text, of any length, is graded for itself and no row is moved; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)
    level = len(model.thresholds) if least is None else least

    @F.pandas_udf("expected_grade double, tail_probability double")
    def graded(text: pd.Series) -> pd.DataFrame:
        tails = sent().tails([x if isinstance(x, str) else None for x in text])
        return pd.DataFrame({"expected_grade": tails.sum(1), "tail_probability": tails[:, level - 1]})

    own = docs.drop(*[c for c in ("expected_grade", "tail_probability", "kept", "text_graded") if c != text_col])
    whole = own.withColumn("text_graded", graded(F.col(text_col).cast("string")))
    return whole.select(*own.columns, "text_graded.*").withColumn("kept", F.col("tail_probability") >= probability)


by_value(__name__)
