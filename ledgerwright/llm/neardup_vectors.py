"""Near-duplicate vectors: spherical-cap filters from structured random product codes."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, durable, map_groups, release, small_batches
from .pairing import link

#: Rows that a filter catches on average of vectors without structure.
BUCKET = 32
#: Filters that two vectors at the threshold are expected to share.
SHARED = 16
#: A sketch has so many sign bits; it only rules pairs out.
BITS = 128
SLACK = 4.5
#: Vectors of one component that are counted against as many others in one task.
BLOCK = 2048
#: Filters of each vector at least: the best ones, where fewer are exceeded.
LEAST_FILTERS = 8
#: Cosines this near the threshold are computed again in one order of additions, so that every place decides alike.
DOUBT = 1e-9


class ProductCode:
    """Filter directions (i, j): direction i for one half of the turned space joined to j for the other.

    A vector passes a filter if the sum of its two scores exceeds `cap`; in random directions
    that is a standard normal score. Of the size x size filters only those exceeded are ever
    looked at: for each i, the j whose score makes up what is missing.
    """

    def __init__(self, dim: int, rows: int, threshold: float):
        normal = NormalDist()
        share = min(0.1, BUCKET / max(rows, 1))
        self.cap = normal.inv_cdf(1 - share)
        both = share * (1 - normal.cdf(self.cap * ((1 - threshold) / (1 + threshold)) ** 0.5))
        self.size = max(4, int(np.ceil((SHARED / both) ** 0.5)))
        rng = np.random.default_rng(dim)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.half = dim // 2
        self.left, self.right = (self._directions(rng, d) for d in (self.half, dim - self.half))
        self.signs = rng.normal(size=(dim, BITS))

    def _directions(self, rng: np.random.Generator, dim: int) -> np.ndarray:
        return rng.normal(size=(max(dim, 1), self.size))[:dim]

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """The filters of each row."""
        turned = unit @ self.turn
        a, b = turned[:, : self.half] @ self.left, turned[:, self.half :] @ self.right
        out = []
        for x, y in zip(a, b, strict=True):
            order = np.argsort(-y)
            falling = -y[order]
            near = np.flatnonzero(x + y[order[0]] >= self.cap)
            many = np.searchsorted(falling, x[near] - self.cap, side="right")
            rows = np.repeat(near, many)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
            found = rows * self.size + order[within]
            if len(found) < LEAST_FILTERS:
                found = np.union1d(found, self._best(x, y))
            out.append(found)
        return out

    def _best(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The LEAST_FILTERS filters of the greatest sums, which are among as many best of each half."""
        k = min(LEAST_FILTERS, self.size)
        i, j = np.argsort(-x)[:k], np.argsort(-y)[:k]
        top = np.argsort(-(x[i][:, None] + y[j][None, :]), axis=None, kind="stable")[:LEAST_FILTERS]
        return i[top // k] * self.size + j[top % k]

    def sketch(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.signs > 0, axis=1)


def canonical(values) -> bytes | None:
    """A vector's components as float64 bytes; None where it can't be compared."""
    if values is None:
        return None
    try:
        v = np.array(values, np.float64)
    except (TypeError, ValueError):
        return None
    if v.ndim != 1 or not len(v) or not np.isfinite(v).all() or not v.any():
        return None
    return (v + 0.0).tobytes()


def unit_rows(raw) -> np.ndarray:
    v = np.frombuffer(b"".join(map(bytes, raw)), np.float64).reshape(len(raw), -1)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit rows of a link with which of b."""
    cosine = a @ b.T
    i, j = np.nonzero(np.abs(cosine - threshold) < DOUBT)
    cosine[i, j] = [float(np.add.reduce(a[p] * b[q])) for p, q in zip(i, j, strict=True)]
    return cosine >= threshold


def most_differing(threshold: float) -> int:
    """Sign bits that may differ: as many as two vectors at the threshold differ in, and SLACK deviations."""
    p = float(np.arccos(threshold) / np.pi)
    return int(BITS * p + SLACK * (BITS * p * (1 - p)) ** 0.5)


def near_vectors(vectors: DataFrame, *, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for each row of vectors, with the id under id_col's name.

    Equal vectors are one class. Classes are decoded into the cap filters they exceed, joined on
    filters, screened by sign sketches, and confirmed by cosines in double precision. The height
    of the caps grows with the number of rows, so a filter catches about as many at any size.
    Within a component, whose members alone can be linked, links are then counted exactly, block
    against block.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing;
    vectors of different lengths never link. Rows without id are kept, have no component and
    link with nothing. Rows that repeat an id are vectors of their own and count as such in
    n_links. An empty table gives an empty result.
    """
    small_batches(vectors.sparkSession)

    @F.pandas_udf("raw binary, cls binary, dim int")
    def canonicals(column: pd.Series) -> pd.DataFrame:
        raw = [canonical(x) for x in column]
        return pd.DataFrame({"raw": raw, "cls": [None if r is None else xxhash.xxh3_128_digest(r) for r in raw], "dim": [0 if r is None else len(r) // 8 for r in raw]})

    own = vectors.select(F.col(id_col).cast("long").alias("id"), canonicals(F.col(vector_col)).alias("v")).select("id", "v.*")
    table = durable(own)
    usable = table.where("cls IS NOT NULL AND id IS NOT NULL")
    classes = durable(usable.groupBy("cls", "raw", "dim").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    # an id that repeats with other components stands for its first vector when links are confirmed
    reps = durable(classes.groupBy("id").agg(F.min_by(F.struct("raw", "dim", "cls", "weight"), "cls").alias("x")).select("id", "x.*"))
    n = reps.count()

    def encode(frames):
        codes: dict[int, ProductCode] = {}
        for frame in frames:
            for dim, some in frame.groupby("dim"):
                if dim not in codes:
                    codes[dim] = ProductCode(dim, n, threshold)
                code = codes[dim]
                unit = unit_rows(some["raw"])
                yield pd.DataFrame({"id": some["id"].to_numpy(), "dim": int(dim), "sketch": [s.tobytes() for s in code.sketch(unit)], "filters": code.decode(unit)})

    coded = durable(reps.select("id", "dim", "raw").mapInPandas(encode, "id long, dim int, sketch binary, filters array<long>"))
    regions = coded.select("id", "dim", F.explode("filters").alias("filter")).select("id", F.xxhash64("dim", "filter").alias("region"))
    most = most_differing(threshold)

    def close(columns, i, j):
        differ = np.bitwise_count(columns["sketch"][i] ^ columns["sketch"][j]).sum(-1).astype(np.int64)
        return np.where((differ <= most) & (columns["dim"][i] == columns["dim"][j]), BITS - differ, -1)

    def load(frame: pd.DataFrame) -> dict[str, np.ndarray]:
        return {"sketch": np.frombuffer(b"".join(map(bytes, frame["sketch"])), np.uint64).reshape(len(frame), -1), "dim": frame["dim"].to_numpy()}

    def check(frame: pd.DataFrame) -> list[tuple[int, int]]:
        found, centre = [], None
        for c, i, leaf, raw in zip(frame["centre"], frame["id"], frame["is_leaf"], frame["raw"], strict=True):
            if not leaf:
                centre = unit_rows([raw])[0]
            elif len(raw) == 8 * len(centre) and linked(unit_rows([raw]), centre[None, :], threshold)[0, 0]:
                found.append((c, i))
        return found

    payload = lambda ids: reps.select("id", "raw").join(ids, "id", "left_semi")
    links, groups = link(regions, coded.select("id", "dim", "sketch"), None, close, load, payload, check)

    members = durable(groups.withColumnsRenamed({"node": "id"}).join(reps.select("id", "raw", "weight"), "id"))
    counts = durable(count_links(members, threshold))
    release(members, coded, links)
    found = classes.select("cls", "id", "weight").join(groups.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left")
    of_class = durable(found.select("cls", F.coalesce("root", "id").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    release(counts, groups, classes, reps)
    out = table.withColumn("joined", F.when(F.col("id").isNotNull(), F.col("cls"))).select("id", "joined").join(of_class, F.col("joined") == F.col("cls"), "left")
    component = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """(id, linked): the vectors linked to each member of (id, root, raw, weight), classes by weight.

    A component is cut into parts, and each part is held against each, itself included.
    """
    sizes = durable(members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("parts")))
    parted = members.join(sizes, "root").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    mine = ("root", "id", "raw", "weight")
    row = parted.select(*mine, "part", every_part.alias("other"), F.lit(True).alias("counts"))
    swapped = parted.select(*mine, every_part.alias("held"), F.col("part").alias("other"), F.lit(False).alias("counts")).withColumnRenamed("held", "part").where("part <> other")
    blocks = row.unionByName(swapped).select(F.concat_ws(":", "root", "part", "other").alias("block"), "counts", "id", "raw", "weight", (F.col("part") == F.col("other")).alias("alone"))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, some in frame.groupby("block", sort=False):
            unit, weight = unit_rows(some["raw"]), some["weight"].to_numpy()
            own = some["counts"].to_numpy()
            against = own if some["alone"].iloc[0] else ~own
            same = some["id"].to_numpy()[own][:, None] == some["id"].to_numpy()[against][None, :]
            count = (linked(unit[own], unit[against], threshold) & ~same) @ weight[against]
            out.append(pd.DataFrame({"id": some["id"].to_numpy()[own], "linked": count}))
        return pd.concat(out)

    parts = map_groups(blocks, "block", count, "id long, linked long", then=("id",))
    return parts.groupBy("id").agg(F.sum("linked").alias("linked"))


by_value(__name__)
