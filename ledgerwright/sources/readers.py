"""Raw files as all-text rows: CSV as it stands, JSON arrays with salvage of what still parses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_scan import Scan

#: Columns that every reader adds: place in the file, the record as JSON, what is lost.
POSITION, RAW, LOST = "_pos", "_raw", "_lost"


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every value as text, '' for blank and missing ones, with _pos, _raw and a null _lost.

    Columns are found by the names in the file's header, in whatever order; a missing one is an
    error, others only stand in _raw. Text that looks like a missing value stays text. A row with
    too many fields aborts the read: a batch must not lose fields. The file is read in splits
    unless a quoted value goes over a line's end; positions are in the order of the file.
    """
    lines = spark.read.text(path)
    open_quote = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    whole = not lines.where(open_quote).isEmpty()
    options = {"header": True, "multiLine": whole, "escape": '"', "quote": '"'}
    names = [c.strip().removeprefix("\ufeff") for c in spark.read.csv(path, **options).columns]
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_broken"]])
    # without pruning, so that a row is counted whole whichever columns are asked for
    rows = spark.read.options(columnPruning=False).csv(path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken", **options)
    # what stands between quotes counts for nothing; the rest of a row that Spark finds of another length is cut at its commas
    bare = F.regexp_replace("_broken", r'(?s)(^|,)\s*"(?:[^"]|"")*"\s*(?=,|$)', "$1")
    too_long = F.col("_broken").isNotNull() & (F.size(F.split(bare, ",", -1)) > len(names))
    values = [F.when(too_long, F.raise_error(F.concat(F.lit("too many fields: "), "_broken"))).otherwise(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in names]
    placed = rows.select(*values, F.monotonically_increasing_id().alias(POSITION))
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))
    return placed.select(*columns, POSITION, record.alias(RAW), F.lit(None).cast("string").alias(LOST))


@dataclass(frozen=True)
class Source:
    """A file's records, and whether its structure is broken."""

    rows: DataFrame
    broken: bool = False


def read_json(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of a JSON array as text columns; absent and null members are null. Lost fragments are rows too."""
    return open_source(spark, path, columns).rows


def open_source(spark: SparkSession, path: str, columns: list[str]) -> Source:
    """A CSV or JSON file, by its name. A JSON file is gone through once or twice here, to know where its objects lie."""
    if not path.endswith(".json"):
        return Source(read_csv(spark, path, columns))
    scan = Scan(spark, path)
    return Source(scan.rows().select(*[F.get_json_object(RAW, f"$.{c}").alias(c) for c in columns], POSITION, RAW, LOST), not scan.sound)


def read_source(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return open_source(spark, path, columns).rows


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, size_bytes, sha256) of a file, or of the files of a folder or pattern.

    A checksum has one order, so a file is one stream through the driver's JVM, in constant memory
    and of any size, as its landing is.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(at)
    files = [f for each in found or [] for f in (fs.listStatus(each.getPath()) if each.isDirectory() else [each]) if not f.isDirectory()]
    rows = [(f.getPath().getName(), f.getLen(), sha256(spark, f.getPath().toString())) for f in files]
    return spark.createDataFrame(rows, "file_name string, size_bytes long, sha256 string")


def sha256(spark: SparkSession, path: str) -> str:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    through = jvm.java.security.DigestInputStream(stream, digest)
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(through, jvm.java.io.OutputStream.nullOutputStream(), 1 << 20, True)
    return bytes(digest.digest()).hex()
