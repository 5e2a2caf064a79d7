"""A session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Wall-clock timestamps without zone, errors instead of silent nulls, and plans adapted at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("ledgerwright")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
