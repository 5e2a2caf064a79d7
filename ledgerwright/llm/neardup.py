"""Near-duplicate documents: MinHash signatures in an LSH forest, links confirmed on full sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_value, durable, release, shared, small_batches
from .pairing import REGION, compare_regions, crossing_regions, link, mixed_regions

SHINGLE = 5
PERMUTATIONS = 64
#: Chance to miss a link at the threshold that the forest may leave.
MISSED = 1e-5
#: Standard deviations of the estimated similarity that a link may fall below the threshold.
SLACK = 3.8
CHUNK_WORDS = 200_000
#: Counters of the frequencies of shingles in dense regions (8 MB); collisions cost time, no links.
SLOTS = 1 << 20
#: Heads of too large regions that a document is paired with, those it meets most often.
HEADS = 2
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all shingles of some texts, in order, with repeats.

    Words are runs of anything but ASCII blanks, A-Z lower-cased. A text of fewer than five
    words is one shingle; one without words has none.
    """
    words = [b"" if t is None else t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
    split = [w.split() for w in words]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in split for w in ws], np.int64)
    value = np.array([xxhash.xxh3_64_intdigest(w) for w in number], np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
    length = np.array([len(ws) for ws in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), length)
    short = np.flatnonzero((length > 0) & (length < SHINGLE))
    first = np.cumsum(length) - length
    hashes, owners = [], []
    if len(ids) >= SHINGLE:
        n = len(ids) - SHINGLE + 1
        h = np.full(n, SHINGLE, np.uint64)
        for k in range(SHINGLE):
            h = (h ^ value[k : n + k]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
        whole = doc[:n] == doc[SHINGLE - 1 :]
        hashes.append(h[whole])
        owners.append(doc[:n][whole])
    if len(short):
        own = [xxhash.xxh3_64_intdigest(b"\x20".join(split[i]), seed=1) for i in short]
        hashes.append(np.array(own, np.uint64))
        owners.append(short)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, o = np.concatenate(hashes), np.concatenate(owners)
    return (h, o) if not len(short) else (h[order := np.argsort(o, kind="stable")], o[order])


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, o = shingle_hashes(texts)
    edge = np.searchsorted(o, np.arange(len(texts) + 1))
    return [np.unique(h[edge[i] : edge[i + 1]]) for i in range(len(texts))]


def chunks(texts: list[str | None]) -> list[tuple[int, int]]:
    """Ranges of texts of about CHUNK_WORDS words."""
    out, start, held = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") // 6 + 1
        if held and held + n > CHUNK_WORDS:
            out.append((start, i))
            start, held = i, 0
        held += n
    return [*out, (start, len(texts))]


def signatures(texts: list[str | None]) -> list[tuple[int, bytes | None, bytes | None]]:
    """(shingles, set class, signature) of each text; no class or signature without words.

    The class is a 128-bit hash of the whole set, the signature 64 MinHashes of 16 bits each.
    """
    rng = np.random.default_rng(11)
    times = rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
    out: list[tuple[int, bytes | None, bytes | None]] = []
    for start, end in chunks(texts):
        sets = shingle_sets(texts[start:end])
        full = [s for s in sets if len(s)]
        mins = np.zeros((len(full), PERMUTATIONS), np.uint16)
        if full:
            h = np.concatenate(full)
            first = np.cumsum([0, *map(len, full[:-1])])
            for p in range(PERMUTATIONS):
                v = h * times[p] + plus[p]
                v ^= v >> np.uint64(29)
                low = np.minimum.reduceat(v * np.uint64(0xBF58476D1CE4E5B9), first)
                mins[:, p] = ((low * np.uint64(0x94D049BB133111EB)) >> np.uint64(48)).astype(np.uint16)
        at = iter(mins)
        out += [(len(s), xxhash.xxh3_128_digest(s.tobytes()), next(at).tobytes()) if len(s) else (0, None, None) for s in sets]
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n_shingles, cls, sig), a row for each row of docs, in one pass over the whole texts."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_shingles long, cls binary, sig binary")
    def signed(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(signatures([x if isinstance(x, str) else None for x in text]), columns=["n_shingles", "cls", "sig"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), signed(text).alias("s")).select("id", "text_hash", "s.*")


def least_depth(threshold: float) -> int:
    """Values that a region shares at least: as many as leave trees enough to find links at the threshold."""
    for depth in range(8, 1, -1):
        if (1 - threshold**depth) ** (PERMUTATIONS // depth) <= MISSED:
            return depth
    return 1


def order_key(least: int, depth: int) -> Column:
    """A hash of the tree and of its first `depth` values; each tree rotates the signature by `least` more."""
    turn = F.col("tree") * (2 * least)
    rotated = F.concat(F.expr(f"substring(sig, {2 * least} * tree + 1)"), F.col("sig").substr(F.lit(1), turn))
    return F.xxhash64("tree", F.substring(rotated, 1, 2 * depth))


def least_agreement(threshold: float) -> int:
    sd = (threshold * (1 - threshold) * PERMUTATIONS) ** 0.5
    return max(1, int(np.ceil(threshold * PERMUTATIONS - SLACK * sd)))


def closeness(threshold: float):
    """Agreeing values of two signatures; below 0 if these or the sizes rule a link out."""
    least = least_agreement(threshold)

    def close(columns: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        agree = (columns["sig"][i] == columns["sig"][j]).sum(-1)
        n, m = columns["n"][i], columns["n"][j]
        return np.where((agree >= least) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9), agree, -1)

    return close


def load_signatures(frame: pd.DataFrame) -> dict[str, np.ndarray]:
    sig = np.frombuffer(b"".join(map(bytes, frame["sig"])), np.uint16).reshape(len(frame), PERMUTATIONS)
    return {"sig": sig, "n": frame["n"].to_numpy()}


def forest(reps: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame | None, DataFrame, list[DataFrame]]:
    """(regions, stars, whole, tables): the groups to start from, pairs (leaf, centre) with heads of what is too large,
    all groups, and the tables that these are read from.

    Every tree is an order of the signatures; documents with a common prefix of
    least_depth() values are a whole region, and links are looked for in all of these. To link
    dense ones early, a region of more than REGION documents is told apart at the next
    depth, so depth follows density. Heads of too large regions (the smallest id, and the
    document that is in most of them, as what others are copies of is) are paired with all their
    members. At the full depth a region stays, whatever its size.
    """
    least = least_depth(threshold)
    depths = [*(d for d in (least, 2 * least, 4 * least, 8 * least) if d < PERMUTATIONS), PERMUTATIONS]
    trees = F.explode(F.sequence(F.lit(0), F.lit(PERMUTATIONS // least - 1))).alias("tree")
    entries = reps.select("id", "sig", trees)
    regions = stars = whole = None
    tables = []
    for depth in depths:
        keyed = entries.select("id", "tree", order_key(least, depth).alias("region"))
        counts = durable(keyed.groupBy("region").agg(F.count("*").alias("many"), F.min("id").alias("head")).where("many > 1"))
        part = durable(keyed.join(counts, "region"))
        release(counts)
        tables.append(part)
        whole = part.select("id", "region") if whole is None else whole
        done = F.lit(True) if depth == PERMUTATIONS else F.col("many") <= REGION
        settled = part.where(done).select("id", "region")
        regions = settled if regions is None else regions.unionByName(settled)
        large = part.where(~done)
        if large.isEmpty():
            break
        often = durable(large.groupBy("id").agg(F.count("*").alias("often")))
        centres = large.join(often, "id").groupBy("region").agg(F.min(F.struct(-F.col("often"), "id")).alias("x"))
        centres = durable(centres.select("region", F.col("x.id").alias("centre")))
        heads = large.join(centres, "region").select(F.col("id").alias("leaf"), F.explode(F.array("head", "centre")).alias("centre")).where("leaf <> centre")
        star = durable(heads.groupBy("leaf", "centre").agg(F.count("*").alias("met")))
        release(often, centres)
        tables.append(star)
        stars = star if stars is None else stars.unionByName(star)
        entries = large.select("id", "tree").join(reps.select("id", "sig"), "id")
    if stars is not None:
        met = stars.groupBy("leaf", "centre").agg(F.sum("met").alias("met")).groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("met")).alias("m"), "centre"))).alias("x"))
        stars = met.select("leaf", F.explode(F.slice("x", 1, HEADS)).alias("x")).select("leaf", "x.centre")
    return regions, stars, whole, tables


def may_link(threshold: float):
    """Whether rows can link whose first common shingle, in the order of rare_first(), has these positions.

    Sets of n and m link only if they share o = t / (1 + t) * (n + m) shingles, so the first
    they share is among the first n - o + 1 of the one and the first m - o + 1 of the other.
    """
    percent = round(threshold * 100)

    def close(columns: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, m = columns["n"][i], columns["n"][j]
        least = -(-percent * (n + m) // (100 + percent))
        fits = (columns["pos"][i] <= n - least) & (columns["pos"][j] <= m - least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        return np.where(fits, 1, -1)

    return close


def rare_first(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in order of how often their counter was hit, then of their hash; and these counts."""
    often = counts[(hashes % np.uint64(SLOTS)).astype(np.int64)]
    order = np.lexsort((hashes, often))
    return hashes[order], often[order]


def dense_pairs(texts, threshold: float):
    """All pairs (leaf, centre) of (id, label) with different labels that may link: an exact prefix filter.

    Shingles are ordered by a count of them among these documents, rare ones first (a table
    of SLOTS counters, whatever the input). Documents that link share one among the first of both, so they
    are joined on those; shingles that only one document has are left out. What all of a region share stands last, so
    similar documents that don't link seldom meet.
    """
    percent = round(threshold * 100)

    def pairs(dense: DataFrame) -> DataFrame:
        spark = dense.sparkSession
        with_text = lambda: texts(dense.select("id")).join(dense, "id")

        def sets_of(frame: pd.DataFrame):
            whole = list(frame["text"])
            for start, end in chunks(whole):
                yield from zip(range(start, end), shingle_sets(whole[start:end]), strict=True)

        def count(frames):
            for frame in frames:
                got = [s for _, s in sets_of(frame)]
                slot, n = np.unique(np.concatenate(got) % np.uint64(SLOTS), return_counts=True)
                yield pd.DataFrame({"slot": slot.astype(np.int64), "n": n})

        found = with_text().select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(SLOTS, np.int64)
        counts[found["slot"].to_numpy()] = found["n"].to_numpy()
        sent = shared(spark, counts)

        def firsts(frames):
            for frame in frames:
                ids, labels = frame["id"].to_numpy(), frame["label"].to_numpy()
                for i, s in sets_of(frame):
                    n = len(s)
                    rare, often = rare_first(s, sent())
                    first = n - -(-percent * n // 100) + 1
                    at = np.flatnonzero(often[:first] > 1)
                    if len(at):
                        yield pd.DataFrame({"region": rare[at].view(np.int64), "id": ids[i], "label": labels[i], "n": n, "pos": at})

        entries = durable(with_text().select("id", "label", "text").mapInPandas(firsts, "region long, id long, label long, n long, pos long"))
        shape = mixed_regions(entries)
        crossing = crossing_regions(entries, shape)
        load = lambda frame: {"n": frame["n"].to_numpy(), "pos": frame["pos"].to_numpy()}
        out = durable(compare_regions(crossing, may_link(threshold), load, True).select("leaf", "centre").distinct())
        release(entries, shape)
        return out

    return pairs


def check_sets(threshold: float):
    percent = round(threshold * 100)

    def check(frame: pd.DataFrame) -> list[tuple[int, int]]:
        found, centre = [], None
        centres, ids, is_leaf = (frame[c].to_numpy() for c in ("centre", "id", "is_leaf"))
        texts = list(frame["text"])
        for start, end in chunks(texts):
            for i, s in enumerate(shingle_sets(texts[start:end]), start):
                if not is_leaf[i]:
                    centre = s
                    continue
                common = len(np.intersect1d(centre, s, assume_unique=True))
                if 100 * common >= percent * (len(centre) + len(s) - common):
                    found.append((centres[i], ids[i]))
        return found

    return check


def near_duplicates(docs: DataFrame, *, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of docs, with the id under id_col's name.

    Documents with the same shingle set are one class, standing for them is the smallest id. The
    forest gives candidates among classes; links are confirmed on full sets, so none is below
    the threshold; components of links are the groups, named by their smallest id.

    The first round compares each document with its closest; a second one all candidates that
    the first left in different groups, in regions of the least depth and any size. In small regions
    signatures say what may link; in dense ones an exact prefix filter does (dense_pairs). So only
    pairs that no region holds can be missed (for a pair at 0.85, about 1 in 100,000), and in
    small regions those whose signatures underrate them (about 1 in 10,000).

    Null texts and texts without words have no shingles and link with nothing. Rows without id
    are kept and have no component. Rows that repeat an id count as one document (one whose
    class of smallest id they share; links are those of its text of the fewest shingles, by
    class and text hash where these tie), and each gets its row. Very long texts are compared by all
    their shingles. Empty tables give an empty result.
    """
    table = durable(sketch(docs, id_col, text_col))
    with_words = table.where("cls IS NOT NULL AND id IS NOT NULL")
    keys = ["cls", "sig", F.col("n_shingles").alias("n")]
    classes = durable(with_words.groupBy(*keys).agg(F.min(F.struct("id", "text_hash")).alias("x")).select("cls", "sig", "n", "x.id", "x.text_hash"))
    reps = durable(classes.groupBy("id").agg(F.min(F.struct("n", "sig", "text_hash")).alias("x")).select("id", "x.n", "x.sig", "x.text_hash"))
    regions, stars, whole, tables = forest(reps, threshold)

    def texts(ids: DataFrame) -> DataFrame:
        """(id, text) of the wanted ids: the text whose signature stands for the id, once."""
        text = F.col(text_col).cast("string")
        own = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
        wanted = durable(ids.distinct().join(reps.select("id", "text_hash"), "id"))
        return own.join(broadcast_if_small(wanted), ["id", "text_hash"], "left_semi").groupBy("id").agg(F.min("text").alias("text"))

    links, groups = link(
        regions, reps.select("id", "n", "sig"), stars, closeness(threshold), load_signatures, texts, check_sets(threshold), whole, dense_pairs(texts, threshold)
    )
    roots = durable(classes.select("cls", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").select("cls", F.coalesce("root", "id").alias("component_id")))
    own = table.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("cls")).alias("cls"))
    component = F.coalesce("component_id", "id")
    out = durable(own.join(roots, "cls", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    ))
    release(table, classes, reps, links, groups, roots, *tables)
    return out


def drop_near_duplicates(docs: DataFrame, *, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of other documents of a group than the one with the smallest id.

    Repeated rows of that document all stay, as do rows without id. All columns stay as they are,
    whatever their names. Null and empty texts are linked with nothing, texts of any length are
    compared whole, equal texts are one group, and an empty table gives an empty result.
    """
    short = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    judged = near_duplicates(short, threshold=threshold)
    gone = durable(judged.where("NOT kept").select(F.col("doc_id").alias("near_gone")).distinct())
    release(judged)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("near_row"), F.col(f"`{id_col}`").alias("near_id"))
    return whole.join(broadcast_if_small(gone), F.col("near_id") == F.col("near_gone"), "left_anti").select("near_row.*")


by_value(__name__)
