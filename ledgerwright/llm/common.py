"""What the corpus operators share: durable intermediate results, size-checked
broadcasts, grouped maps without one Python call per group, and connected components."""

from __future__ import annotations

import pickle
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table may be broadcast up to so many rows and so many bytes of its files.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 8 << 20
#: Arrow batches stay this small because a single text may be very long.
BATCH_ROWS = 256
#: A word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def by_value(module: str) -> None:
    """Ship a module's functions inside the task, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows, and with them the bytes, that a Python worker holds at once."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all of the cluster shares: spark.checkpoint.dir.

    Where that is unset, a temporary folder serves a session within this one process; any other
    master is an error, since executors elsewhere would not see the driver's folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Compute df once into a table in the shared folder, and read it from there: its lineage ends."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    at, fs = _folder(spark, path)
    fs.delete(at, True)


def release(*tables: DataFrame) -> None:
    """Delete tables that durable() wrote, once nothing will read them."""
    for df in tables:
        drop_folder(df.sparkSession, df.stored_at)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A durable table with a broadcast hint if it has at most `rows` rows and BROADCAST_BYTES, else unhinted."""
    at, fs = _folder(df.sparkSession, df.stored_at)
    small = fs.getContentSummary(at).getLength() <= BROADCAST_BYTES and df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if small else df


def shared(spark: SparkSession, value) -> Callable:
    """A function that gives `value` in tasks: sent once to each executor, loaded once by each worker."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        if not hasattr(sent, "loaded"):
            sent.loaded = pickle.loads(sent.value)
        return sent.loaded

    return get


def ascii_lower(text: Column) -> Column:
    """text with A to Z, and nothing else, in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def hex_fraction(text: Column) -> Column:
    """A reproducible number in [0, 1) from a text: the first 8 digits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def map_groups(
    df: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    then: tuple[str, ...] = (),
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """fn over frames that each hold many whole groups of `key`, sorted by key and `then`.

    Unlike applyInPandas this has no cost per group. The caller bounds a group's size. With more
    batch_rows than usual the caller sets the session's batches, as its rows are short.
    """
    if batch_rows <= BATCH_ROWS:
        small_batches(df.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            last = frame[key].iloc[-1]
            if held and last == held[-1][key].iloc[-1]:
                held.append(frame)
                if sum(map(len, held)) < 50_000 and frame[key].iloc[0] == last:
                    continue
            else:
                held.append(frame)
            whole = pd.concat(held, ignore_index=True) if len(held) > 1 else frame
            tail = whole[key] == last
            if (ready := whole[~tail]).shape[0]:
                yield fn(ready.reset_index(drop=True))
            held = [whole[tail]]
        if held:
            yield fn(pd.concat(held, ignore_index=True))

    # a stated number of partitions keeps adaptive coalescing from piling groups into few tasks
    return df.repartition(key).sortWithinPartitions(key, *then).mapInPandas(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b), as (node, root): root is the smallest reachable id.

    Edges point from the larger to the smaller id. In each step every node finds its smallest
    neighbour; its other neighbours are hooked to that one, and the node itself to the smallest
    neighbour of that. The steps needed grow with the logarithm of the longest path. A step is
    one pre-aggregated minimum, written, two joins with it that can be split where a node has very
    many links, and one distinct; nothing is collected but a checksum, and each step's table
    replaces the one before. Null ids and self links are ignored. An empty input gives an empty result.
    """
    proper = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = durable(proper.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        low = durable(e.groupBy("u").agg(F.min("v").alias("m")))
        hooked = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        onward = low.select(F.col("u").alias("m"), F.col("m").alias("mm"))
        jumped = low.join(onward, "m", "left").select("u", F.coalesce("mm", "m").alias("v"))
        after = durable(hooked.unionByName(jumped).distinct())
        release(e, low)
        e = after
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    whole = durable(pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct()))
    release(e)
    return whole
