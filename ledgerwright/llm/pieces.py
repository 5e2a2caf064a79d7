"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

Equal-length words advance together, one character at a time. At each place the substrings that
end there are looked up by their hash among the sorted keys of the pieces, every candidate is
scored, and the best one's length is stored as back pointer.

For a unigram model the score is the sum of piece scores. For a byte-pair model it is 0 where the
candidate follows the piece before it as merging would leave them, else minus infinity: a sequence
of pieces is what merging makes of a text exactly if merging leaves each two neighbours alone.
(Merges of two neighbours run in the same order alone and inside a text, as long as none crosses
their outer ends; so the first merge that crossed a boundary would cross it in that pair as well.)
So one search serves both kinds of model and gives the library's own pieces.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, shared, small_batches

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
HASH = np.uint64(0x5851F42D4C957F2D)
#: Words whose pieces a task remembers.
REMEMBERED = 500_000
#: Two to this power answers about two neighbours are remembered.
PAIR_BITS = 20
#: How much worse than the worst piece an unknown character is in a unigram model.
UNKNOWN_PENALTY = 10.0


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a protocol buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = b[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(b):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, b[i : i + n]
        i += n


def chain_hash(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes along the last axis, a column longer than codes."""
    h = np.zeros((*codes.shape[:-1], codes.shape[-1] + 1), np.uint64)
    for k in range(codes.shape[-1]):
        h[..., k + 1] = h[..., k] * HASH + codes[..., k].astype(np.uint64) + np.uint64(1)
    return h


def codes_of(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)


class Store:
    """Words and their ids, one after the other in one array."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.ends, self.used = np.zeros(1 << 16, np.int32), [np.zeros(1, np.int64)], 0

    def add(self, words: list[str], ids: np.ndarray, many: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.ends.append(self.used + np.cumsum(many))
        self.used += len(ids)

    def get(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words that are there."""
        if len(self.ends) > 1:
            self.ends = [np.concatenate(self.ends)]
        place, first = self.place, self.ends[0]
        at = np.array([place[w] for w in words], np.int64)
        start, many = first[at], first[at + 1] - first[at]
        end = np.cumsum(many)
        return self.flat[np.repeat(start - end + many, many) + np.arange(end[-1] if len(end) else 0)], many


@dataclass
class PieceModel:
    """A model's pieces, with what the search needs. Ids from vocabulary size on stand for unknown characters."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    model_type: int
    dummy_prefix: bool
    byte_fallback: bool
    unknown: int
    histories: dict[int, tuple[list[float], list[str], list[str]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        normal = [i for i, k in enumerate(self.kinds) if k == NORMAL]
        self.id_of = {self.pieces[i]: i for i in normal}
        keys = np.array([int(chain_hash(codes_of(self.pieces[i]))[-1]) for i in normal], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(normal, np.int64)[order]
        self.key_lengths = np.array([len(self.pieces[i]) for i in normal])[order]
        self.lengths = sorted({len(self.pieces[i]) for i in normal})
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.powers = np.array([pow(int(HASH), n, 1 << 64) for n in self.lengths], np.uint64)
        self.pair_keys, self.pair_values = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.young, self.old = Store(), Store()
        self.splitter = re.compile(self._parts())
        self._surfaces()

    @classmethod
    def parse(cls, raw: bytes) -> PieceModel:
        """From the bytes of a .model file; raises ValueError for models with other normalisation or user pieces."""
        pieces, scores, kinds, trainer, normal = [], [], [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                pieces.append(f[1].decode())
                scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                kinds.append(f.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or USER in kinds or trainer.get(24, 0):
            raise ValueError("models that rewrite texts or have user-defined pieces are not supported")
        if any(SPACE in p.lstrip(SPACE) for p, k in zip(pieces, kinds, strict=True) if k == NORMAL):
            raise ValueError("models whose pieces go across words are not supported")
        return cls(pieces, np.array(scores), np.array(kinds), trainer.get(3, UNIGRAM), bool(normal.get(3, 1)), bool(trainer.get(35, 0)), kinds.index(UNKNOWN))

    def history(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """How merging (best score first, then leftmost) makes a piece from its characters.

        The score of each merge, and the first and last parts before, between and after them;
        None if it ends otherwise than with the one piece.
        """
        if piece not in self.histories:
            parts = list(self.pieces[piece])
            scores, firsts, lasts = [], [parts[0]], [parts[-1]]
            while True:
                found = [(-self.scores[i], k) for k in range(len(parts) - 1) if (i := self.id_of.get(parts[k] + parts[k + 1])) is not None]
                if not found:
                    break
                score, k = min(found)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                scores.append(-score)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.histories[piece] = (scores, firsts, lasts) if len(parts) == 1 else None
        return self.histories[piece]

    def follows(self, before: int, piece: int) -> bool:
        """Whether merging the two pieces' characters leaves just these two (before -1: only piece)."""
        right = self.history(piece)
        if before < 0 or right is None:
            return right is not None
        left = self.history(before)
        if left is None:
            return False
        (one, _, lasts), (two, firsts, _) = left, right
        i = j = 0
        while True:
            across = self.id_of.get(lasts[i] + firsts[j])
            a = one[i] if i < len(one) else -np.inf
            b = two[j] if j < len(two) else -np.inf
            if across is not None and self.scores[across] > a and self.scores[across] >= b:
                return False
            if i == len(one) and j == len(two):
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """follows() of many at once; anything may follow an unknown character."""
        keys = np.where(before >= len(self.pieces), 0, before + 1) * (1 << 20) + piece
        slot = ((keys.astype(np.uint64) * HASH) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        missing = np.flatnonzero(self.pair_keys[slot] != keys)
        out = self.pair_values[slot]
        if len(missing):
            fresh, at = np.unique(keys[missing], return_inverse=True)
            values = np.array([self.follows((k >> 20) - 1, k & ((1 << 20) - 1)) for k in fresh.tolist()], bool)
            out[missing] = values[at]
            self.pair_keys[slot[missing]], self.pair_values[slot[missing]] = keys[missing], values[at]
        return out

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, how many) of words of one length, one after the other; unknown characters are vocabulary size + code point."""
        m, n = len(words), len(words[0])
        codes = codes_of("".join(words)).reshape(m, n)
        h = chain_hash(codes)
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        last = np.full((m, n + 1), -1, np.int64)
        back = np.zeros((m, n + 1), np.int64)
        merges = self.model_type == BPE
        worst = 0.0 if merges else self.scores.min() - UNKNOWN_PENALTY
        for i in range(1, n + 1):
            sizes = np.array([x for x in self.lengths if x <= i])
            key = h[:, i, None] - h[:, i - sizes] * self.powers[: len(sizes)]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (self.key_lengths[at] == sizes)
            single = hit[:, 0] if sizes[0] == 1 else np.zeros(m, bool)
            rows, cols = np.nonzero(hit & (best[:, i - sizes] > -np.inf))
            piece, start = self.key_ids[at[rows, cols]], i - sizes[cols]
            if merges:
                score = np.where(self.allowed(last[rows, start], piece), 0.0, -np.inf)
            else:
                score = best[rows, start] + self.scores[piece]
            scores = np.full((m, len(sizes) + 1), -np.inf)
            scores[rows, cols] = score
            scores[:, -1] = np.where(single, -np.inf, best[:, i - 1] + worst)
            top = scores.argmax(1)
            every = np.arange(m)
            best[:, i] = scores[every, top]
            known = top < len(sizes)
            last[:, i] = np.where(known, self.key_ids[at[every, np.minimum(top, len(sizes) - 1)]], len(self.pieces) + codes[:, i - 1].astype(np.int64))
            back[:, i] = np.where(known, sizes[np.minimum(top, len(sizes) - 1)], 1)
        every, place = np.arange(m), np.full(m, n)
        steps: list[np.ndarray] = []
        while (place > 0).any():
            steps.append(np.where(place > 0, last[every, place], -1))
            place = place - back[every, place]
        table = np.stack(steps[::-1], 1)
        return table[table >= 0], (table >= 0).sum(1)

    def ids(self, found: np.ndarray) -> np.ndarray:
        """Ids of found pieces: unknown characters become their bytes, or one unknown id for each run."""
        size = len(self.pieces)
        if not (found >= size).any():
            return found.astype(np.int32)
        out: list[int] = []
        for x in found.tolist():
            if x < size:
                out.append(x)
            elif self.byte_fallback:
                out += [self.byte_ids[b] for b in chr(x - size).encode("utf-8", "replace")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32)

    def _parts(self) -> str:
        """A pattern of the parts of a text that no piece goes across.

        Always runs of spaces with what follows. Where no piece joins letters to anything else,
        letters stand apart from the rest, and where none has a line end, so do line ends; then
        fewer different parts have to be searched.
        """
        alone = "\n" if self.byte_fallback and not any("\n" in p for p in self.id_of) else ""
        # word characters that are neither letters nor digits, like the squared sign
        odd = "".join(sorted({c for p in self.id_of for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}))
        letter = re.compile(f"[^\\W\\d_{odd}]")
        inner = [(bool(letter.match(a)), bool(letter.match(b))) for p in self.id_of for a, b in zip(p, p[1:], strict=False) if SPACE not in (a, b)]
        ends = f"{alone}|" if alone else ""
        if all(a == b for a, b in inner) and self.byte_fallback:
            return f"{ends}{SPACE}*[^\\W\\d_{odd}]+|{SPACE}*(?:[^\\w{SPACE}{alone}]|[\\d_{odd}])+|{SPACE}+"
        return f"{ends}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"

    def words(self, text: str) -> list[str]:
        """The parts of a text, spaces marked."""
        return self.splitter.findall((" " + text if self.dummy_prefix else text).replace(" ", SPACE))

    def learn(self, words: list[str]) -> None:
        """Search words and remember their ids."""
        fresh: dict[int, list[str]] = {}
        for w in words:
            fresh.setdefault(len(w), []).append(w)
        size = len(self.pieces)
        for n, same in fresh.items():
            step = max(1, 500_000 // n)
            for k in range(0, len(same), step):
                some = same[k : k + step]
                found, many = self.search(some)
                if (found >= size).any():
                    each = [self.ids(x) for x in np.split(found, np.cumsum(many)[:-1])]
                    found, many = np.concatenate(each), np.array([len(x) for x in each])
                self.young.add(some, found, many)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text; null stays null, empty gives none.

        Words of the current and the previous generation are remembered.
        """
        split = [self.words(t) if t else [] for t in texts]
        if len(self.young.place) > REMEMBERED:
            self.old, self.young = self.young, Store()
        young, old = self.young.place, self.old.place
        missing = {w for ws in split for w in ws if w not in young}
        again = [w for w in missing if w in old]
        self.young.add(again, *self.old.get(again))
        self.learn([w for w in missing if w not in old])
        ids, many = self.young.get([w for ws in split for w in ws])
        edge = np.concatenate([[0], np.cumsum(many)])[np.cumsum([0, *map(len, split)])]
        return [None if t is None else ids[edge[i] : edge[i + 1]] for i, t in enumerate(texts)]

    def _surfaces(self) -> None:
        """The bytes of all pieces in one array; the last is that of ids that are none."""
        each = [self._surface(i) for i in range(len(self.pieces))] + [" ⁇ ".encode()]
        self.surface = np.frombuffer(b"".join(each), np.uint8)
        self.surface_size = np.array([len(x) for x in each], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size

    def decode(self, rows: list[np.ndarray | None]) -> list[str | None]:
        """Texts of ids: control pieces vanish; unknown, null and out-of-range ids give the mark of the unknown piece."""
        none, mark = len(self.pieces), " ⁇ ".encode()
        out: list[str | None] = []
        for ids in rows:
            if ids is None:
                out.append(None)
                continue
            if getattr(ids, "dtype", None) != np.int32:  # nulls among the ids arrive as not a number
                ids = np.array([-1 if x is None or x != x else x for x in ids], np.int64)
            known = np.where((ids >= 0) & (ids < none), ids, none)
            size = self.surface_size[known]
            end = np.cumsum(size)
            at = np.repeat(self.surface_start[known] - end + size, size) + np.arange(end[-1] if len(end) else 0)
            joined = self.surface[at].tobytes()
            if self.dummy_prefix and joined.startswith(b" ") and not joined.startswith(mark):
                joined = joined[1:]
            out.append(joined.decode("utf-8", "replace"))
        return out

    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else self.pieces[i].replace(SPACE, " ").encode()


def load(spark: SparkSession, path: str) -> PieceModel:
    """The model in a .model file, on the driver's disk or where Spark can read it (under a megabyte or two)."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            return PieceModel.parse(file.read())
    return PieceModel.parse(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))


def encode(docs: DataFrame, model: PieceModel, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the ids of each whole text (a column of that name is replaced).

    The ids are those of the library for the same model. Null texts have null ids, empty ones
    none. Each row is encoded for itself and none is moved. Words that a task meets again are
    not searched again.
    """
    small_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf("array<int>")
    def encoded(text: pd.Series) -> pd.Series:
        return pd.Series(sent().encode([x if isinstance(x, str) else None for x in text]), dtype=object)

    return docs.withColumn(ids_col, encoded(F.col(text_col).cast("string")))


def decode(docs: DataFrame, model: PieceModel, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """docs with the text of each row's ids (a column of that name is replaced); null ids give null.

    Decoding what was encoded gives the text, but for U+2581, which the pieces use for the space.
    """
    small_batches(docs.sparkSession)
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        return pd.Series(sent().decode(list(ids)), dtype=object)

    return docs.withColumn(text_col, decoded(F.col(ids_col)))


by_value(__name__)
