"""Raw files landed as they are, and sinks that others read."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from .readers import file_metadata


def land(spark: SparkSession, path: str, bronze: str | None, batch_id: str, tries: int = 3) -> bool:
    """Copy a file to bronze/batch=<id>/ unless it is there with the same checksum; whether it was copied.

    Without a bronze folder nothing is done. The checksum is kept beside the file.
    """
    if not bronze:
        return False
    meta = file_metadata(spark, path).first()
    target = f"{bronze}/batch={batch_id}/{meta['file_name']}"
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (path, target, f"{target}.sha256")]
    source, there, note = paths
    fs = there.getFileSystem(conf)
    if fs.exists(there) and fs.exists(note) and spark.read.text(note.toString()).first()[0] == meta["sha256"]:
        return False
    for left in range(tries - 1, -1, -1):
        try:
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, there, False, True, conf)
            out = fs.create(note, True)
            out.write(bytearray(meta["sha256"].encode()))
            out.close()
            return True
        except Exception:
            if not left:
                raise
            time.sleep(1)
    return False


def write_quarantine(rejected: DataFrame, path: str) -> bool:
    """record_key, reason_codes and raw_record as CSV; nothing is written for an empty frame."""
    if rejected.isEmpty():
        return False
    rejected.select("record_key", "reason_codes", "raw_record").write.mode("overwrite").csv(path, header=True, escape='"')
    return True
