"""From groups of similar rows to confirmed links, without ever making all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_value, components, durable, map_groups, release

#: Rows of one region that are compared with each other in one task.
REGION = 200
#: Rows of a region of several components beyond which its rows are compared by `exact` in the second round.
DENSE = 64
#: Rows that each row is confirmed with in the first round, of all that its regions name.
CLOSEST = 2
#: Leaves of one star that are confirmed in one task.
LEAVES = 128

#: closeness(columns, i, j): how close rows i and j seem, below 0 where they can't link.
Closeness = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray]


def closest(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, other): the CLOSEST rows of each row that has any."""
    order = np.argsort(-close, axis=1, kind="stable")[:, :CLOSEST]
    row = np.repeat(np.arange(len(close)), order.shape[1])
    other = order.ravel()
    possible = close[row, other] >= 0
    return row[possible], other[possible]


def compare_regions(regions: DataFrame, closeness: Closeness, load: Callable[[pd.DataFrame], dict[str, np.ndarray]], every: bool) -> DataFrame:
    """Pairs (leaf, centre, close) of bounded regions (region, id, label, ...), with repeats.

    Each row names its closest ones; with `every`, all rows that may link and whose labels differ.
    """

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        columns = load(frame)
        region, ids, label = (frame[c].to_numpy() for c in ("region", "id", "label"))
        edge = np.flatnonzero(np.r_[True, region[1:] != region[:-1], True])
        two = edge[:-1][np.diff(edge) == 2]  # most regions, all at once
        near = closeness(columns, two, two + 1)
        may = near >= 0
        if every:
            may &= label[two] != label[two + 1]
        two, near = two[may], near[may]
        one, other, how = [two, two + 1], [two + 1, two], [near, near]
        for start, end in zip(edge[:-1], edge[1:], strict=True):
            if end - start < 3:
                continue
            close = np.empty((end - start, end - start), np.int64)
            for k in range(start, end, 64):
                i = np.arange(k, min(k + 64, end))[:, None]
                close[k - start : k - start + 64] = closeness(columns, i, np.arange(start, end)[None, :])
            np.fill_diagonal(close, -1)
            if (close < 0).all():
                continue
            if every:
                a, b = np.nonzero(np.triu((close >= 0) & (label[start:end, None] != label[None, start:end])))
            else:
                a, b = closest(close)
            one.append(start + a)
            other.append(start + b)
            how.append(close[a, b])
        a, b, how = np.concatenate(one), np.concatenate(other), np.concatenate(how)
        keep = ids[a] != ids[b]
        return pd.DataFrame({"leaf": ids[a[keep]], "centre": ids[b[keep]], "close": how[keep]}, dtype="int64")

    return map_groups(regions, "region", compared, "leaf long, centre long, close long", then=("id",))


def undirected(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("leaf", "centre").alias("a"), F.greatest("leaf", "centre").alias("b")).distinct()


def first_choices(pairs: DataFrame) -> DataFrame:
    """Of the pairs (leaf, centre, close) the CLOSEST of each leaf. A leaf has a few for each region it is in."""
    listed = pairs.groupBy("leaf").agg(F.sort_array(F.collect_set(F.struct((-F.col("close")).alias("far"), "centre"))).alias("x"))
    return listed.select("leaf", F.explode(F.slice("x", 1, CLOSEST)).alias("x")).select("leaf", "x.centre")


def split_regions(entries: DataFrame) -> DataFrame:
    """Regions (region, id) of any size as (region, id, head) of at most REGION rows, by a hash of the id.

    head is the smallest id of the whole region if that was split, else null.
    """
    counts = durable(entries.groupBy("region").agg(F.count("*").alias("many"), F.min("id").alias("head")).where("many > 1"))
    parts = F.ceil(F.col("many") / REGION).cast("long")
    part = F.pmod(F.xxhash64("id", "region"), parts)
    out = durable(entries.join(counts, "region").select(
        F.when(F.col("many") <= REGION, F.col("region")).otherwise(F.xxhash64("region", part)).alias("region"),
        F.col("region").alias("whole"),
        "id",
        F.when(F.col("many") > REGION, F.col("head")).alias("head"),
    ))
    release(counts)
    return out


def mixed_regions(entries: DataFrame) -> DataFrame:
    """(region, many, top) of the regions (region, id, label) of more than one label: rows, and the commonest label."""
    labels = entries.groupBy("region", "label").agg(F.count("*").alias("n"))
    return durable(labels.groupBy("region").agg(F.sum("n").alias("many"), F.max(F.struct("n", "label")).alias("top")).where("many > top.n"))


def crossing_regions(entries: DataFrame, shape: DataFrame) -> DataFrame:
    """The mixed regions of (region, id, label, ...) as bounded ones that still hold every pair of different labels.

    A region that is too large is cut into blocks: all its rows, a part at a time, against the
    rows outside its most frequent label, a part at a time. Rows of that label need no pairs
    among themselves, so a dense group costs in proportion to its size.
    """
    own = entries.columns
    placed = entries.join(shape, "region").select(
        *own, "many", F.ceil(F.col("many") / REGION).alias("rows"),
        F.greatest(F.lit(1), F.ceil((F.col("many") - F.col("top.n")) / REGION)).alias("odds"),
        (F.col("label") != F.col("top.label")).alias("odd"),
    )
    rest = [c for c in own if c != "region"]
    large = placed.where(F.col("many") > 2 * REGION)
    mine = F.pmod(F.xxhash64("id", "region"), F.col("rows"))
    ours = F.pmod(F.xxhash64("region", "id"), F.col("odds"))
    as_row = large.select("region", *rest, mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("odds") - 1)).alias("j"))
    # a row that stands in its block already does not come again
    as_odd = large.where("odd").select("region", *rest, F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), ours.alias("j"), mine.alias("own")).where("i <> own").drop("own")
    blocks = as_row.unionByName(as_odd).select(F.xxhash64("region", "i", "j").alias("region"), *rest)
    return placed.where(F.col("many") <= 2 * REGION).select("region", *rest).unionByName(blocks)


def confirm(pairs: DataFrame, payload: Callable[[DataFrame], DataFrame], check: Callable[[pd.DataFrame], list[tuple[int, int]]]) -> DataFrame:
    """The pairs (a, b) that `check` confirms on the payload.

    payload(ids): the rows (id, ...) of the wanted ids, one each. A pair is looked at where its
    end with more pairs is (its centre), and a centre with many leaves is spread over several
    tasks, so each payload travels to few tasks. check gets frames sorted by block (a centre and
    some of its leaves), the centre first, with columns centre, id, is_leaf and the payload.
    """
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    hubs = durable(ends.groupBy("a").agg(F.count("*").alias("degree")).where(F.col("degree") > LEAVES))
    known = broadcast_if_small(hubs)
    degrees = pairs.join(known.withColumnsRenamed({"degree": "da"}), "a", "left").join(known.withColumnsRenamed({"a": "b", "degree": "db"}), "b", "left")
    da, db = F.coalesce("da", F.lit(1)), F.coalesce("db", F.lit(1))
    swap = db > da
    leaf = F.when(swap, F.col("a")).otherwise(F.col("b"))
    part = F.pmod(F.xxhash64(leaf), F.ceil(F.greatest(da, db) / LEAVES))
    star = durable(degrees.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("centre"), leaf.alias("leaf"), part.alias("part")))
    wanted = star.select("centre", "part", F.col("leaf").alias("id")).unionByName(star.select("centre", "part", F.col("centre").alias("id")).distinct())
    needed = durable(wanted.select("id").distinct())
    placed = wanted.join(payload(needed), "id").withColumn("block", F.concat_ws(":", "centre", "part")).withColumn("is_leaf", F.col("id") != F.col("centre"))

    def checked(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(check(frame), columns=["a", "b"], dtype="int64")

    links = durable(map_groups(placed.drop("part"), "block", checked, "a long, b long", then=("is_leaf", "id")))
    release(hubs, star, needed)
    return links


def link(
    regions: DataFrame,
    rows: DataFrame,
    extra: DataFrame | None,
    closeness: Closeness,
    load: Callable[[pd.DataFrame], dict[str, np.ndarray]],
    payload: Callable[[DataFrame], DataFrame],
    check: Callable[[pd.DataFrame], list[tuple[int, int]]],
    whole: DataFrame | None = None,
    exact: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links, components) of rows (id, ...) that share a region (region, id) of any size.

    A first round confirms each row with its closest in all regions, and `extra` pairs
    (leaf, centre). What that leaves in different components is compared in a second round, every
    pair of it that closeness allows, in the regions or, where given, in the `whole` ones
    (region, id) that hold these; so components miss no pair that shares such a region and is
    close. Where `exact` is given, rows of mixed regions of more than DENSE rows go to it instead,
    as (id, label): it returns all pairs (leaf, centre) of different labels that may link.
    """
    parts = split_regions(regions)
    known = durable(parts.select("region", "id").join(rows, "id").withColumn("label", F.col("id")))
    chosen = first_choices(compare_regions(known, closeness, load, False))
    heads = parts.where("id <> head").select(F.col("id").alias("leaf"), F.col("head").alias("centre"))
    chosen = chosen.unionByName(heads if extra is None else heads.unionByName(extra))
    first = durable(undirected(chosen))
    release(known)
    links = confirm(first, payload, check)
    groups = components(links)

    whole = parts.select(F.col("whole").alias("region"), "id") if whole is None else whole
    labelled = durable(whole.join(groups.withColumnRenamed("node", "id"), "id", "left").select("region", "id", F.coalesce("root", "id").alias("label")))
    shape = mixed_regions(labelled)
    small = shape if exact is None else shape.where(F.col("many") <= DENSE)
    crossing = durable(crossing_regions(labelled, small).join(rows, "id"))
    rest = compare_regions(crossing, closeness, load, True).select("leaf", "centre")
    if exact is not None:
        dense = labelled.join(shape.where(F.col("many") > DENSE).select("region"), "region").select("id", "label").distinct()
        dense = durable(dense)
        if not dense.isEmpty():
            rest = rest.unionByName(exact(dense))
    rest = durable(undirected(rest).join(first, ["a", "b"], "left_anti"))
    release(parts, first, labelled, shape, crossing)
    if rest.isEmpty():
        release(rest)
        return links, groups
    release(groups)
    both = durable(links.unionByName(confirm(rest, payload, check)))
    release(links, rest)
    return both, components(both)


by_value(__name__)
