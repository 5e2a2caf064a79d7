"""JSON arrays of objects of any size, read in pieces by many tasks; broken ones give all objects that still parse.

A file is read in splits at its opening braces, and a few megabytes of such pieces are a chunk, so
every chunk but the first begins with a brace. A chunk's objects are found by going from brace to brace,
which needs to know where the last object of the chunk before ends. All chunks begin at their first
brace at once; those into which an object reaches are gone through again from where it ends, until
no end moves any more. That is one repetition unless a defect lies across a border.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# executors get the functions with the task and need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
ROWS = "_pos long, _raw string, _lost string"
#: Characters of a chunk, and of the chunk after it that is read on at first.
CHUNK, AHEAD = 4 << 20, 1 << 16
#: A defect so near the end of what was read may be the end itself.
CUT = 32



def texts(values: list[str | None]) -> pd.Series:
    return pd.Series(values, dtype=object)


@dataclass
class Walk:
    """What a chunk's objects gave: rows (record, lost), where the next chunk begins, whether all was as it should be."""

    rows: list[tuple[str | None, str | None]] = field(default_factory=list)
    onward: int = 0
    sound: bool = True
    short: bool = False


def walk(text: str, ahead: str = "", entry: int = 0, first: bool = True, last: bool = True, whole: bool = True) -> Walk:
    """The objects that begin in text[entry:]; they may reach into `ahead`.

    first, last: whether the file begins and ends with this text. whole: whether it ends with what is
    ahead; if not, an object that is cut off there makes the walk `short`.

    A document that is not an array of objects, all else being JSON, counts as broken too. Between objects of a sound file stands one comma, before them a bracket, behind them another. Else blanks,
    commas and square brackets may be dropped there, and any other text is lost. A brace that no object
    begins with is lost up to the next one.
    """
    out, all_text, decoder = Walk(), text + ahead, json.JSONDecoder()
    begun = not first

    def between(gap: str, pattern: str) -> None:
        out.sound &= re.fullmatch(pattern, gap) is not None
        if re.search(r"[^\s,\[\]]", gap):
            out.rows.append((None, gap.strip()))

    at = entry
    while at <= len(text):
        brace = all_text.find("{", at)
        if brace < 0 or brace >= len(text):
            if last and brace < 0:
                out.sound &= re.fullmatch(r"\s*\]\s*" if begun else r"\s*\[\s*\]\s*", all_text[at:]) is not None
            else:
                between(all_text[at : len(text)], r"\s*,\s*" if begun else r"\s*\[\s*")
            at = len(text)
            break
        if brace or first or entry:
            between(all_text[at:brace], r"\s*,\s*" if begun else r"\s*\[\s*")
        begun = True
        try:
            record, at = decoder.raw_decode(all_text, brace)
            out.rows.append((json.dumps(record, sort_keys=True, ensure_ascii=False), None))
        except (json.JSONDecodeError, RecursionError) as error:
            if not whole and isinstance(error, json.JSONDecodeError) and (error.msg.startswith("Unterminated") or error.pos >= len(all_text) - CUT):
                out.short = True
                return out
            at = all_text.find("{", brace + 1)
            at = len(all_text) if at < 0 else at
            out.rows.append((None, all_text[brace:at].strip()))
            out.sound = False
    out.onward = at - len(text)
    if last and at > len(text):
        out.sound &= re.fullmatch(r"\s*\]\s*", all_text[at:]) is not None
    return out


def salvage(text: str) -> Iterator[tuple[str | None, str | None]]:
    """(record as JSON, None) for every object of a text, (None, fragment) for what is lost."""
    yield from walk(text).rows


def chunks_of(spark: SparkSession, path: str) -> DataFrame:
    """(block, part, text): a file cut at opening braces, in splits. Blocks are places in the file."""
    pieces = spark.read.option("lineSep", "{").text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    size = CHUNK

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, part, held, length, head = None, 0, [], 0, ""

        def chunk() -> pd.DataFrame:
            return pd.DataFrame({"block": [block], "part": [part], "text": texts([head + "{".join(held)])})

        for frame in frames:
            for at, value in zip(frame["block"].tolist(), frame["value"].tolist(), strict=True):
                if held and (at != block or length >= size):
                    yield chunk()
                    part, held, length = (part + 1 if at == block else 0), [], 0
                if not held:
                    # only what stands before the first brace of the file has none
                    head = "" if at == 0 and part == 0 else "{"
                    block = at
                held.append(value)
                length += len(value) + 1
        if held:
            yield chunk()

    return pieces.mapInPandas(joined, "block long, part int, text string")


def ends_with_brace(spark: SparkSession, path: str) -> bool:
    """Whether a file's last byte is an opening brace, behind which its reader sees no piece."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    length = fs.getFileStatus(at).getLen()
    stream = fs.open(at)
    try:
        stream.seek(max(0, length - 1))
        return length > 0 and stream.read() == ord("{")
    finally:
        stream.close()


class Scan:
    """A file's chunks, numbered, with the place where each one's objects begin.

    The driver holds two numbers for each chunk, of CHUNK characters.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        chunks = chunks_of(spark, path)
        order = sorted((r["block"], r["part"]) for r in chunks.select("block", "part").collect())
        self.count = len(order)
        numbers = spark.createDataFrame([(b, p, n) for n, (b, p) in enumerate(order)], "block long, part int, n long")
        tail = F.when(F.col("n") == self.count - 1, F.lit("{" if ends_with_brace(spark, path) else "")).otherwise(F.lit(""))
        self.chunks = chunks.join(F.broadcast(numbers), ["block", "part"]).select("n", F.concat("text", tail).alias("text"))
        self.entries = [0] * self.count
        self.reach = [0] * self.count
        self.sound = True
        self._settle()

    def _placed(self, wanted: list[int]) -> DataFrame:
        """The wanted chunks with their entries and the text after them: a beginning of the next chunk, or several whole ones."""
        rows = [(n, self.entries[n], self.reach[n]) for n in wanted]
        where = self.spark.createDataFrame(rows, "n long, entry long, reach long")
        mine = self.chunks.join(F.broadcast(where), "n")
        most = max(self.reach[n] for n in wanted)
        behind = self.chunks.select(F.col("n").alias("at"), "text").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(max(1, most))))).withColumn("n", F.col("at") - F.col("n")).join(F.broadcast(where), "n")
        text = F.when(F.col("reach") == 0, F.left("text", F.lit(AHEAD))).otherwise(F.col("text"))
        close = F.col("at") - F.col("n") <= F.greatest("reach", F.lit(1))
        ahead = behind.where(close).select("n", "at", text.alias("ahead"), (F.length("text") > F.length(text)).alias("cut"))
        ahead = ahead.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("at", "ahead", "cut"))).alias("x"))
        seen = F.coalesce(F.element_at("x.at", -1), F.col("n")) < self.count - 1
        return mine.join(ahead, "n", "left").select(
            "n", "entry", "text", F.coalesce(F.array_join("x.ahead", ""), F.lit("")).alias("ahead"), (~(seen | F.coalesce(F.exists("x.cut", lambda c: c), F.lit(False)))).alias("whole"))

    def _settle(self) -> None:
        """Entries of all chunks, and whether the file is sound."""
        found: dict[int, tuple[int, bool]] = {}
        wanted, last = list(range(self.count)), self.count - 1

        def walked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for r in frame.itertuples():
                    w = walk(r.text, r.ahead, r.entry, r.n == 0, r.n == last, r.whole)
                    yield pd.DataFrame({"n": [r.n], "onward": [w.onward], "sound": [w.sound], "short": [w.short]})

        while wanted:
            ends = self._placed(wanted).mapInPandas(walked, "n long, onward long, sound boolean, short boolean").collect()
            again = set()
            for r in ends:
                if r["short"]:
                    self.reach[r["n"]] = max(1, 4 * self.reach[r["n"]])
                    again.add(r["n"])
                else:
                    found[r["n"]] = (max(0, r["onward"]), r["sound"])
            for n in range(1, self.count):
                if n - 1 in found and found[n - 1][0] != self.entries[n]:
                    self.entries[n] = found[n - 1][0]
                    again.add(n)
            wanted = sorted(again)
        self.sound = all(sound for _, sound in found.values())

    def rows(self) -> DataFrame:
        """(_pos, _raw, _lost) of the file's objects and lost fragments, in order of _pos."""
        if not self.count:
            return self.spark.createDataFrame([], ROWS)
        last = self.count - 1

        def walked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for r in frame.itertuples():
                    rows = walk(r.text, r.ahead, r.entry, r.n == 0, r.n == last, r.whole).rows
                    yield pd.DataFrame({"_pos": [(r.n << 32) + k for k in range(len(rows))], "_raw": texts([x for x, _ in rows]), "_lost": texts([x for _, x in rows])})

        return self._placed(list(range(self.count))).mapInPandas(walked, ROWS)


def state(files: DataFrame, text: str) -> DataFrame:
    """files with rows_read, fragments_lost and broken (file flag) instead of the column of their texts, each a whole document."""

    @F.pandas_udf("rows_read long, fragments_lost long, broken boolean")
    def walked(texts: pd.Series) -> pd.DataFrame:
        walks = [walk(t) for t in texts]
        lost = [sum(x is not None for _, x in w.rows) for w in walks]
        return pd.DataFrame({"rows_read": [len(w.rows) - n for w, n in zip(walks, lost, strict=True)], "fragments_lost": lost, "broken": [not w.sound for w in walks]})

    return files.withColumn("_state", walked(F.coalesce(F.col(text), F.lit("")))).select(*[c for c in files.columns if c != text], "_state.*")


def salvage_texts(files: DataFrame) -> DataFrame:
    """(_pos, _raw, _lost) of texts (value), each a whole document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["value"]:
                rows = list(salvage(text))
                yield pd.DataFrame({"_pos": range(len(rows)), "_raw": texts([r for r, _ in rows]), "_lost": texts([x for _, x in rows])})

    return files.select("value").mapInPandas(run, ROWS)
