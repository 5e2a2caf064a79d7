"""Spelling variants: words that differ by one edit, found by parity masks of their letters, and the common form of each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_value, durable, map_groups, release

#: Bits of a mask. Letters by falling frequency, so that each band gets common and rare ones alike.
BITS = 63
ORDER = "etaoinsrhldcumfpgwybvkxjqz"
BANDS = 3
BAND = tuple(np.uint64(sum(1 << b for b in range(BITS) if b % BANDS == k)) for k in range(BANDS))
#: Rows of one bucket that are compared in one piece; a larger bucket is compared piece against piece.
BUCKET = 4096
#: Buckets of at most so many rows are gone through together; larger ones by blocks of so many rows.
SMALL, BLOCK = 48, 512
#: Words that a Python worker gets at once, and cells (letters, or candidates' letters) that it works on at once.
WORDS, CELLS = 8192, 4_000_000


def letter_bits(chars: np.ndarray) -> np.ndarray:
    """The bit of each code point: a to z have their own, all others share the rest."""
    table = np.zeros(128, np.uint64)
    for k, c in enumerate(ORDER):
        table[ord(c)] = k
    known = (chars >= ord("a")) & (chars <= ord("z"))
    return np.where(known, table[np.where(known, chars, 0)], np.uint64(len(ORDER)) + chars.astype(np.uint64) * np.uint64(7) % np.uint64(BITS - len(ORDER)))


def parity_masks(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length (a row each): the parity of each letter's number, and of each letter at each place.

    An insertion or deletion flips one bit of the first, a replacement at most two of the second.
    """
    bit = letter_bits(chars)
    place = np.arange(chars.shape[1], dtype=np.uint64)
    one = np.uint64(1)
    letters = np.bitwise_xor.reduce(one << bit, axis=1)
    placed = np.bitwise_xor.reduce(one << ((bit * np.uint64(11) + place * np.uint64(5)) % np.uint64(BITS)), axis=1)
    return letters, placed


def matrix(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    n = len(words[0])
    return np.array(words, f"<U{max(1, n)}").view(np.uint32).reshape(len(words), max(1, n))[:, :n]


def texts(words: list[str], at: np.ndarray) -> pd.Series:
    return pd.Series([words[i] for i in at], dtype=object)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, matrix of code points) of words of equal length, at most CELLS letters (or one word) at once."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    edge = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0, True]) if len(words) else [0]
    for start, end in zip(edge[:-1], edge[1:], strict=True):
        n = max(1, int(lengths[order[start]]))
        step = max(1, CELLS // n)
        for k in range(start, end, step):
            at = order[k : min(k + step, end)]
            yield at, matrix([words[i] for i in at])


def bucketed(frame: pd.DataFrame) -> pd.DataFrame:
    """Nine entries for each word (word, n): kinds 0 to 2 for words of its length, 3 to 5 for one letter more or less."""
    words = frame["word"].tolist()
    out = []
    for at, chars in by_length(words):
        letters, placed = parity_masks(chars)
        length = chars.shape[1]
        for k in range(BANDS):
            for kind, mask, bits, low in ((k, placed, placed & BAND[k], length), (k + BANDS, letters, letters & ~BAND[k], length), (k + BANDS, letters, letters & ~BAND[k], length - 1)):
                out.append(pd.DataFrame({"kind": kind, "low": low, "bits": bits.view(np.int64), "mask": mask.view(np.int64), "row": at}))
    whole = pd.concat(out, ignore_index=True)
    row = whole.pop("row").to_numpy()
    return whole.assign(word=texts(words, row), n=frame["n"].to_numpy()[row])


def one_edit(words: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ by exactly one inserted, deleted or replaced code point. a is not the longer one."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    near = np.zeros(len(a), bool)
    for n in np.unique(length[a]):
        for more in (0, 1):
            mine = np.flatnonzero((length[a] == n) & (length[b] == n + more))
            for k in range(0, len(mine), step := max(1, CELLS // int(n + 1))):
                at = mine[k : k + step]
                x, y = matrix([words[i] for i in a[at]]), matrix([words[i] for i in b[at]])
                if more:
                    head = np.cumprod(x == y[:, :-1], axis=1).sum(axis=1)
                    tail = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                    near[at] = head + tail >= n
                else:
                    near[at] = (x != y).sum(axis=1) == 1
    return near


def halves(words: list[str], low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first half of `low` letters of each word and of its last letters up to as many as the rest of `low`.

    One edit leaves one of the two as it is. low: the length of the shorter word of a pair.
    """
    head, tail = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for at, chars in by_length(words):
        factor = np.cumprod(np.full(chars.shape[1] + 1, 0x9E3779B97F4A7C15, np.uint64))
        for n in np.unique(low[at]):
            mine = low[at] == n
            h = int(n) // 2
            some = chars[mine].astype(np.uint64) + np.uint64(1)
            head[at[mine]] = (some[:, :h] * factor[:h]).sum(axis=1)
            tail[at[mine]] = (some[:, some.shape[1] - (int(n) - h) :] * factor[: int(n) - h]).sum(axis=1)
    return head, tail


def compared(frame: pd.DataFrame) -> pd.DataFrame:
    """Near words of whole buckets. All small buckets are gone through at once, a large one by blocks of rows."""
    key = frame["key"].to_numpy()
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    sizes = np.diff(edge)
    mask = frame["mask"].to_numpy().view(np.uint64)
    kind, low, part, across = (frame[c].to_numpy() for c in ("kind", "low", "part", "across"))
    words, n = frame["word"].tolist(), frame["n"].to_numpy()
    length = np.fromiter(map(len, words), np.int64, len(words))
    head, tail = halves(words, low)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def verified() -> None:
        nonlocal found
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        near = one_edit(words, a, b)
        out.append((np.r_[a[near], b[near]], np.r_[b[near], a[near]]))
        found = []

    def candidates(a: np.ndarray, b: np.ndarray) -> None:
        halved = (head[a] == head[b]) | (tail[a] == tail[b])
        a, b = a[halved], b[halved]
        x, k, grown = mask[a] ^ mask[b], kind[a], length[b] - length[a]
        empty = [x & band == 0 for band in BAND]
        replaced = (grown == 0) & np.select([k == 0, k == 1, k == 2], [empty[0], empty[1] & ~empty[0], empty[2] & ~empty[0] & ~empty[1]], False)
        moved = (np.abs(grown) == 1) & (np.bitwise_count(x) == 1) & np.select([k == j + BANDS for j in range(BANDS)], [~empty[j] for j in range(BANDS)], False)
        keep = (kind[b] == k) & (low[a] == low[b]) & (replaced | moved) & (~across[a] | (part[a] != part[b]))
        a, b = a[keep], b[keep]
        if len(a):
            swap = length[a] > length[b]
            found.append((np.where(swap, b, a), np.where(swap, a, b)))
            if sum(len(x) for x, _ in found) > 500_000:
                verified()

    end = np.repeat(edge[1:], sizes)
    alive, step = np.flatnonzero(np.repeat(sizes <= SMALL, sizes)), 0
    while True:
        step += 1
        alive = alive[end[alive] > alive + step]
        if not len(alive):
            break
        a = alive[np.bitwise_count(mask[alive] ^ mask[alive + step]) <= 2]
        candidates(a, a + step)
    for start, stop in zip(edge[:-1][sizes > SMALL], edge[1:][sizes > SMALL], strict=True):
        rows = np.arange(start, stop)
        for k in np.unique(kind[start:stop]):
            mine = rows[kind[start:stop] == k]
            one, other, flips = (mine, mine, 2) if k < BANDS else (mine[length[mine] == low[mine]], mine[length[mine] != low[mine]], 1)
            for i in range(0, len(one), BLOCK):
                for j in range(i if k < BANDS else 0, len(other), BLOCK):
                    x, y = np.nonzero(np.bitwise_count(mask[one[i : i + BLOCK]][:, None] ^ mask[other[j : j + BLOCK]][None, :]) <= flips)
                    a, b = one[i + x], other[j + y]
                    once = a < b if k < BANDS else slice(None)
                    candidates(a[once], b[once])
    if found:
        verified()
    a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (alive, alive)
    return pd.DataFrame({"word": texts(words, a), "other": texts(words, b), "other_n": n[b]})


def near_words(words: DataFrame) -> DataFrame:
    """Both directions (word, other, other_n) of each pair of words (word, n), distinct, that differ by one edit. A durable table.

    Masks are cut into three bands. A replacement flips at most two bits of the placed mask, so one
    band at least stays; words of one length meet on it. An insertion flips one bit of the plain
    mask, so two bands stay; words of lengths that differ by one meet on both. Pairs that meet are
    held to the masks, then compared letter by letter. A pair is found once: at the first band
    that is equal, or at the one band that isn't.
    """
    spark = words.sparkSession

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from (bucketed(frame) for frame in frames if len(frame))

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(WORDS))
    try:
        made = words.mapInPandas(entries, "kind int, low long, bits long, mask long, word string, n long")
        made = durable(made.select(F.xxhash64("kind", "low", "bits").alias("key"), "kind", "low", "mask", "word", "n"))
        hot = durable(made.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > BUCKET))
        sized = made.join(broadcast_if_small(hot), "key", "left")
        parts = F.coalesce(F.ceil(F.col("many") / BUCKET), F.lit(1)).cast("long")
        sized = sized.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        # of a bucket in several parts a row goes to its own piece and to those of its part with each other one
        placed = sized.select("key", "kind", "low", "mask", "word", "n", "part", "parts", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("with"))
        placed = placed.select(
            F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("part", "with"), F.greatest("part", "with"))).alias("key"),
            "kind", "low", "mask", "word", "n", "part", (F.col("part") != F.col("with")).alias("across"),
        )
        found = durable(map_groups(placed, "key", compared, "word string, other string, other_n long", then=("word",), batch_rows=WORDS))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    release(made, hot)
    return found


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), which has no cycles: forms followed to the last one. A durable table.

    Each step joins the table with itself and doubles the distance. A form has at least `ratio`
    times its word's count, so there are few steps.
    """
    at = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("last"))
        after = durable(at.join(onward, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")))
        release(at)
        at = after
        if at.where("moved").isEmpty():
            return at


def grouped(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Words (word, n) with their form, root, n_near and form_n.

    A word's form is its near word of largest n (ties: the smallest in code-point order), if that
    has at least `ratio` times the word's n. root: forms followed to the last; the word itself if
    it has none. words: distinct; null words or counts are left out. Any code points and any
    length will do; letters other than a to z only make masks coarser. Equal counts are told
    apart by code-point order, an empty table gives an empty result, other columns are left out.
    A word has at most about 90 near words for each of its letters, so no key grows without bound.
    """
    known = durable(words.where("word IS NOT NULL AND n IS NOT NULL").select("word", F.col("n").cast("long").alias("n")))
    near = near_words(known)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    top = -F.col("best.less")
    has = top >= ratio * F.col("n")
    judged = durable(known.join(best, "word", "left").select(
        "word", F.when(has, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, top).alias("form_n")))
    release(near, known)
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def runs(text: Column, least: int) -> Column:
    """The maximal runs of Latin letters of at least `least` code points; none for null."""
    return F.regexp_extract_all(text, F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least},}})"), F.lit(1))


by_value(__name__)
