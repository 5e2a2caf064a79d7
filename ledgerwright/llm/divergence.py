"""How sources of a language differ in their terms: exact sums over joint histograms of counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, by_value, durable, small_batches

#: A term is a run of ASCII letters and anything beyond ASCII, which is all bytes from 80 on in UTF-8. Others become blanks.
AS_TERMS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
#: A language keeps the terms of at least so many of its documents.
LEAST_DOCUMENTS = 10
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Ranks of the part `term`.
TOP = 10
#: Pairs that a Python worker makes at once, and combinations that it holds before it hands them on.
PAIRS, HELD = 1_000_000, 2_000_000
#: Occurrences of terms that it holds at once while it counts, and rows that it merges or hands on at once; fewer if they have so many bytes.
TERMS, ROWS, BYTES = 2_000_000, 50_000, 64 << 20


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact at any count."""
    return F.expr(f"1 + CAST({UNIT} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0)) DIV CAST({total} + 2 * {terms} AS DECIMAL(20,0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) DIV ({p} + {q})")


def runs(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins in a sorted array, and its length."""
    starts = np.flatnonzero(np.r_[np.ones(min(1, len(of)), bool), of[1:] != of[:-1]])
    return starts, np.diff(np.r_[starts, len(of)])


def cells_of(held: list[tuple[np.ndarray, np.ndarray, pa.ListArray]]) -> Iterator[pa.RecordBatch]:
    """(lang_id, term, docs, ids, counts) of some texts: their languages, their groups and the texts as lists of terms."""
    langs, groups, texts = zip(*held, strict=True)
    lang, group = np.concatenate(langs), np.concatenate(groups)
    lengths = np.concatenate([pc.list_value_length(t).to_numpy() for t in texts])
    coded = pa.concat_arrays([t.flatten() for t in texts]).dictionary_encode()
    code, words = coded.indices.to_numpy(), coded.dictionary
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    if (blank := words.index("").as_py()) >= 0:
        doc, code = doc[code != blank], code[code != blank]
    if not len(code):
        return
    ids, first, at = np.unique(group, return_index=True, return_inverse=True)
    key = code.astype(np.int64) * len(ids) + at[doc]
    key.sort()
    starts, n = runs(key)
    term, number = key[starts] // len(ids), key[starts] % len(ids)
    # the same cells in the same order, from each text's distinct terms
    once = doc.astype(np.int64) * len(words) + code
    once.sort()
    once = once[runs(once)[0]]
    once = once % len(words) * len(ids) + at[once // len(words)]
    once.sort()
    _, docs = runs(once)
    # ids are in order of languages, so the cells of a language's term lie together
    spoken = lang[first][number]
    rows = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (spoken[1:] != spoken[:-1])])
    offsets = pa.array(np.r_[rows, len(term)], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(values)) for values in (ids[number], n)]
    yield from pa.table([pa.array(spoken[rows]), words.take(pa.array(term[rows])), pa.array(np.add.reduceat(docs, rows)), *lists], names=["lang_id", "term", "docs", "ids", "counts"]).to_batches(ROWS)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang_id, term, docs, ids, counts) of texts (lang_id, id, text): documents of each term and its occurrences by group, over what a task holds at once."""
    held: list[tuple[np.ndarray, np.ndarray, pa.ListArray]] = []
    terms = size = 0
    for batch in batches:
        if not len(batch):
            continue
        text = batch.column("text")
        _, offsets, data = text.buffers()
        low = (data.to_pybytes() if data else b"").translate(AS_TERMS)
        split = pc.split_pattern(pa.Array.from_buffers(text.type, len(text), [None, offsets, pa.py_buffer(low)], offset=text.offset), " ")
        # more than BYTES only in a batch by itself
        if held and (terms + len(split.values) > TERMS or size + len(low) > BYTES):
            yield from cells_of(held)
            held, terms, size = [], 0, 0
        held.append((batch.column("lang_id").to_numpy(), batch.column("id").to_numpy(), split))
        terms += len(split.values)
        size += len(low)
    if held:
        yield from cells_of(held)


def merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows of counted(), equal (lang_id, term) next to each other, as one row for each."""
    table = pa.Table.from_batches(batches).combine_chunks()
    lang, term = table["lang_id"].to_numpy(), table["term"].combine_chunks()
    other = np.r_[True, (lang[1:] != lang[:-1]) | pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)]
    rows = np.flatnonzero(other)
    lists = [table[c].combine_chunks() for c in ("ids", "counts")]
    ids, counts = (x.flatten().to_numpy() for x in lists)
    row = np.repeat(np.cumsum(other) - 1, pc.list_value_length(lists[0]).to_numpy())
    key = row * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    starts, _ = runs(key[order])
    offsets = pa.array(np.searchsorted(row[order][starts], np.arange(len(rows) + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(values)) for values in (ids[order][starts], np.add.reduceat(counts[order], starts))]
    return pa.RecordBatch.from_arrays([pa.array(lang[rows]), term.take(pa.array(rows)), pa.array(np.add.reduceat(table["docs"].to_numpy(), rows)), *lists], names=batches[0].schema.names)


def kept_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang_id, term, n, ids, counts) of the terms in enough documents, of rows of counted() that lie together by (lang_id, term)."""
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def enough(whole: pa.RecordBatch) -> pa.RecordBatch:
        some = whole.filter(pc.greater_equal(whole.column("docs"), LEAST_DOCUMENTS))
        counts = some.column("counts")
        ends = np.r_[0, np.cumsum(counts.flatten().to_numpy())]
        upto = np.r_[0, np.cumsum(pc.list_value_length(counts).to_numpy())]
        return pa.RecordBatch.from_arrays([some.column("lang_id"), some.column("term"), pa.array(np.diff(ends[upto])), some.column("ids"), counts], names=["lang_id", "term", "n", "ids", "counts"])

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        size += batch.nbytes
        if rows > ROWS or size > BYTES:
            # the last term may go on in the next batch
            whole = merged(held)
            yield enough(whole[:-1])
            held, rows, size = [whole[-1:]], 1, 0
    if held:
        yield enough(merged(held))


def kept_terms(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang_id, term, n, ids, counts): each language's kept terms, with the ids of the groups that have them and their counts. Durable."""
    small_batches(docs.sparkSession)
    texts = docs.join(broadcast_if_small(groups), ["lang", "source"]).select("lang_id", "id", "text")
    cells = "ids array<long>, counts array<long>"
    counts = texts.mapInArrow(counted, f"lang_id long, term string, docs long, {cells}")
    together = counts.repartition("lang_id", "term").sortWithinPartitions("term", "lang_id")
    return durable(together.mapInArrow(kept_of, f"lang_id long, term string, n long, {cells}"))


def tallied(keys: list[np.ndarray], times: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns, with the sum of `times` of each, or how often it is there."""
    if not len(keys[0]):
        return keys, np.zeros(0, np.int64)
    code, wide = np.zeros(len(keys[0]), np.int64), 1
    lows, spans = [int(c.min()) for c in keys], [int(c.max()) - int(c.min()) + 1 for c in keys]
    for column, low, span in zip(keys, lows, spans, strict=True):
        if wide * span >= 1 << 62:
            # too wide for one number: both are numbered anew
            _, code = np.unique(code, return_inverse=True)
            _, column = np.unique(column, return_inverse=True)
            wide, low, span = int(code.max()) + 1, 0, int(column.max()) + 1
            spans = []
        code = code * span + (column - low)
        wide *= span
    if times is None and spans:
        code.sort()
        starts, total = runs(code)
        rest, out = code[starts], []
        for low, span in zip(lows[::-1], spans[::-1], strict=True):
            out.append(rest % span + low)
            rest = rest // span
        return out[::-1], total
    order = np.argsort(code, kind="stable")
    starts, total = runs(code[order])
    return [column[order[starts]] for column in keys], total if times is None else np.add.reduceat(times[order], starts)


def joint_counts(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Combinations (a, b, count of a, count of b) and how many terms have each, of pairs of groups a < b that share a term.

    ids and counts: those of some terms one after the other, `lengths` of each, in order of id.
    """
    end = np.repeat(np.cumsum(lengths), lengths)
    partners = end - np.arange(len(ids)) - 1
    upto = np.cumsum(partners)
    start = 0
    while start < len(ids):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, side="right")))
        n = partners[start:stop]
        first = np.repeat(np.arange(start, stop), n)
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        if len(first):
            yield tallied([ids[first], ids[second], counts[first], counts[second]])
        start = stop


def joint_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Signed cells (a, b, x, y, times): each shared term in its cell, and taken out of the cells of zeros that it was counted into."""
    held: list[tuple[list[np.ndarray], np.ndarray]] = []

    def cells() -> pd.DataFrame:
        (a, b, x, y), times = tallied([np.concatenate(c) for c in zip(*(keys for keys, _ in held), strict=True)], np.concatenate([t for _, t in held]))
        zero = np.zeros_like(x)
        four = [np.r_[a, a, a, a], np.r_[b, b, b, b], np.r_[x, x, zero, zero], np.r_[y, zero, y, zero]]
        keys, times = tallied(four, np.r_[times, -times, -times, times])
        return pd.DataFrame(dict(zip("abxy", keys, strict=True)) | {"times": times})

    for frame in frames:
        if len(frame):
            lengths = frame["ids"].str.len().to_numpy(np.int64)
            held += joint_counts(np.concatenate(frame["ids"].to_numpy()).astype(np.int64), np.concatenate(frame["counts"].to_numpy()).astype(np.int64), lengths)
            if sum(len(t) for _, t in held) > HELD:
                keys, times = tallied([np.concatenate(c) for c in zip(*(keys for keys, _ in held), strict=True)], np.concatenate([t for _, t in held]))
                held = [(keys, times)]
                if len(times) > HELD // 2:
                    yield cells()
                    held = []
    if held:
        yield cells()


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and its most telling terms.

    Part `pair`: item is another source, value the sum over all kept terms of f(p, q) of their
    shares. Part `term`: item is a kept term that is commoner in the source than in the language,
    value its f; ranks to TOP.

    f is evaluated once for each pair of sources and combination of their counts, times the terms
    that have it. All terms of a source are first counted as absent from the other; a term that
    both have moves from there to its own cell, so terms of one source or of neither are in the
    tally without a row each. Work in proportion to the kept terms' pairs of sources that have
    them, and to the result, which has a row for each pair.

    Null texts, languages and sources are empty ones; texts of any length are taken whole; equal rows
    count each. Equal values rank by the item's UTF-8 bytes. A group without kept terms has zero
    counts; a language without any has values of 0 and no terms. An empty table gives an empty
    result. Other columns, of any name, are not looked at.
    """
    column = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = docs.select(column(lang_col).alias("lang"), column(source_col).alias("source"), column(text_col).alias("text"))
    # a row for each source of a language: as long as the result at most, so one window may number them
    numbers = Window.orderBy("lang", "source")
    groups = durable(docs.select("lang", "source").distinct().withColumn("id", F.row_number().over(numbers).cast("long")).withColumn("lang_id", F.dense_rank().over(Window.orderBy("lang")).cast("long")))
    kept = kept_terms(docs, groups)

    each = kept.select("lang_id", "term", F.col("n").alias("in_lang"), F.explode(F.arrays_zip("ids", "counts")).alias("x")).select("lang_id", "term", "in_lang", F.col("x.ids").alias("id"), F.col("x.counts").alias("n"))
    own = each.groupBy("id").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = kept.groupBy("lang_id").agg(F.sum("n").alias("lang_total"), F.count("*").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    sizes = durable(groups.join(own, "id", "left").join(langs, "lang_id", "left").select("id", "lang_id", "lang", "source", *map(zero, ("total", "terms", "v", "lang_total"))))
    small = broadcast_if_small(sizes)

    one, other = (small.select("lang_id", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "terms", "v")]) for k in "ab")
    pairs = one.join(other, "lang_id").where("id_a < id_b")
    neither = pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), (F.col("v_a") - F.col("terms_a") - F.col("terms_b")).alias("times"))
    histogram = each.groupBy("lang_id", "id", "n").agg(F.count("*").alias("times"))
    partner = small.select("lang_id", F.col("id").alias("with"))
    alone = histogram.join(partner, "lang_id").where("id <> with")
    first = F.col("id") < F.col("with")
    alone = alone.select(F.least("id", "with").alias("a"), F.greatest("id", "with").alias("b"), F.when(first, F.col("n")).otherwise(0).alias("x"), F.when(first, 0).otherwise(F.col("n")).cast("long").alias("y"), "times")
    shared = kept.where(F.size("ids") > 1).select("ids", "counts").mapInPandas(joint_cells, "a long, b long, x long, y long, times long")
    tally = neither.unionByName(alone).unionByName(shared).groupBy("a", "b", "x", "y").agg(F.sum("times").alias("times"))

    sized = [small.select(F.col("id").alias(k), F.col("total").alias(f"total_{k}"), *([F.col("v")] if k == "a" else [])) for k in "ab"]
    weighed = tally.join(sized[0], "a").join(sized[1], "b")
    with_terms = weighed.where("times <> 0 AND v > 0").withColumn("p", share("x", "total_a", "v")).withColumn("q", share("y", "total_b", "v"))
    values = with_terms.groupBy("a", "b").agg(F.sum(divergence("p", "q") * F.col("times")).alias("value"))
    known = durable(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).join(values, ["a", "b"], "left").select("a", "b", F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    both = known.select(F.col("a").alias("id"), F.col("b").alias("with"), "value").unionByName(known.select(F.col("b").alias("id"), F.col("a").alias("with"), "value"))
    named = both.join(small.select("id", "lang", "source"), "id").join(small.select(F.col("id").alias("with"), F.col("source").alias("item")), "with")
    far = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    shares = each.join(small.select("id", "lang", "source", "total", "v", "lang_total"), "id").withColumn("p", share("n", "total", "v")).withColumn("q", share("in_lang", "lang_total", "v"))
    telling = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return far.withColumn("rank", F.row_number().over(order)).unionByName(top)


by_value(__name__)
