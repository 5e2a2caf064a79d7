"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, broadcast_if_small, durable, hex_fraction

#: No document is taken more often than this, and no source's target exceeds this times its size.
MAX_REPEAT = 3
SEED = "mix-1"
#: The columns that mix() looks at, by the name of its option.
KEYS = {"id_col": "doc_id", "source_col": "source", "size_col": "size"}
#: Rows of one cell (source, size class, digits of the key's hash) that one task may have to sort.
CELL_ROWS = 250_000


def word_count(text: Column) -> Column:
    """Words of a text (runs of anything but ASCII blanks); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source's join key that is never null and keeps null apart from any text."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def cyclic_weights(totals: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights for sources in code point order, null last, repeating `cycle`.

    totals: a row per source with `source`. The window without partition is over a table of
    one row per source, which is as long as the list of weights that somebody states.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return totals.select(
        source_key(F.col("source")).alias("mix_key"),
        F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).cast("double").alias("weight"),
    )


def water_fill(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets that share the whole size by weight, capped at max_repeat times the source's size.

    sizes: (mix_key, weight, source_size), a row per source. What a cap cuts off is shared
    again by weight among the others until none is above its cap: that is one common level
    times each weight, found with prefix sums over the sources in order of cap / weight.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), "mix_key")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (
        sizes.withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("place", F.row_number().over(order))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min_by("level", F.when(F.col("open"), F.col("place"))).over(everything))
        .withColumn(
            "target",
            F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(math.inf))),
        )
        .select("mix_key", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    weights=cyclic_weights,
    *,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
) -> DataFrame:
    """docs with `source_size`, `target` and `copies` of each row (columns of these names are replaced).

    weights: a function from a table of one row per `source` to (mix_key, weight).

    Within a source the documents stand in order of size class (large first), then of a hash
    of their id. The expected copies (target / source size, the same for all of a source) are
    summed along that order, one random offset per source is added, and a document gets a copy
    for each whole number its interval crosses. Neighbours in the order have almost equal size,
    so the words taken differ from the target by little more than one large document.

    No task holds a source: ranks are taken in cells (source, size class, leading hash digits),
    whose starts are prefix sums over pre-aggregated counts. More rows give more digits. An id that
    more than CELL_ROWS rows have gets cells of its own, by a hash of the whole row; such ids are
    rows / CELL_ROWS at most.

    Null source: a source of its own, last. Null size: 0. Rows without id stand in the order of a
    hash of the whole row. Equal rows are told apart by their rank only, so they may share their
    copies in either way. Other columns of any name stay. A source without words has target 0 and
    gives no copies; an empty table gives an empty result. Reruns give the same copies.
    """
    n = docs.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / CELL_ROWS, 16))) if n else 1
    added = ("source_size", "target", "copies")
    kept = [c for c in docs.columns if c in (id_col, source_col, size_col) or c not in added]
    column = lambda c: F.col(f"`{c}`")
    d = docs.select(
        F.struct(*map(column, kept)).alias("mix_row"), column(id_col).alias("mix_id"), column(source_col).alias("mix_source"),
        F.coalesce(column(size_col).cast("long"), F.lit(0)).alias("mix_size"), F.xxhash64(*map(column, kept)).alias("mix_whole"),
    )
    often = d.where("mix_id IS NOT NULL").groupBy(F.col("mix_id").alias("mix_hot")).agg(F.count("*").alias("mix_often"))
    often = durable(often.where(F.col("mix_often") > CELL_ROWS))
    binary = F.bin("mix_size")
    hashed = F.md5(F.coalesce(F.col("mix_id").cast("string"), F.concat(F.lit("row "), F.col("mix_whole").cast("string"))).cast("binary"))
    own_cell = F.concat("mix_hash", F.lit("."), F.pmod("mix_whole", F.ceil(F.col("mix_often") / CELL_ROWS)).cast("string"))
    d = (
        d.withColumn("mix_key", source_key(F.col("mix_source")))
        .withColumn("mix_class", F.concat(F.lpad(F.length(binary).cast("string"), 2, "0"), F.rpad(F.substring(binary, 1, 4), 4, "0")))
        .withColumn("mix_hash", hashed)
        .join(F.broadcast(often), F.col("mix_id") == F.col("mix_hot"), "left")
        .withColumn("mix_cell", F.coalesce(own_cell, F.substring("mix_hash", 1, digits)))
        .select("mix_row", "mix_id", "mix_size", "mix_whole", "mix_key", "mix_class", "mix_hash", "mix_cell")
    )
    keys = ["mix_key", "mix_class", "mix_cell"]
    cells = durable(d.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("mix_size").alias("words")))

    source = F.when(F.col("mix_key") != "n", F.substring("mix_key", 2, 1_000_000_000)).alias("source")
    per_source = durable(cells.groupBy("mix_key").agg(F.sum("words").alias("source_size")).select("mix_key", "source_size", source))
    targets = durable(water_fill(per_source.join(weights(per_source), "mix_key").select("mix_key", "weight", "source_size"), max_repeat))

    classes = cells.groupBy("mix_key", "mix_class").agg(F.sum("n").alias("n"))
    by_class = Window.partitionBy("mix_key").orderBy(F.desc("mix_class")).rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("mix_key", "mix_class", F.coalesce(F.sum("n").over(by_class), F.lit(0)).alias("class_start"))
    by_cell = Window.partitionBy("mix_key", "mix_class").orderBy("mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cells.withColumn("start", F.coalesce(F.sum("n").over(by_cell), F.lit(0)))
        .join(classes, ["mix_key", "mix_class"])
        .join(broadcast_if_small(targets), "mix_key")
        .select(
            *keys,
            (F.col("class_start") + F.col("start")).alias("mix_start"),
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("mix_rate"),
            hex_fraction(F.concat(F.lit(seed), F.col("mix_key"))).alias("mix_offset"),
        )
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("mix_hash", "mix_id", "mix_whole"))
    reached = lambda at: F.floor(at * F.col("mix_rate") + F.col("mix_offset"))
    at = F.col("mix_start") + F.col("mix_rank")
    out = (
        d.withColumn("mix_rank", rank)
        .join(starts, keys)
        .withColumn("copies", F.least(reached(at) - reached(at - 1), F.lit(max_repeat)).cast("long"))
    )
    return out.select("mix_row.*", *[c for c in added if c not in kept])


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each row of docs as often as mix() says, with the columns of docs."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *[F.col(f"`{options.get(c, name)}`") for c, name in KEYS.items()])
    out = mix(whole, **options).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return out.select("whole", copies).select("whole.*")
