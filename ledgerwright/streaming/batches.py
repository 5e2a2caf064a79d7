"""Batches that arrive as files: each new marker file starts its batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def watch(spark: SparkSession, folder: str, checkpoint: str, run: Callable[[str], object], batches: Sequence[str]) -> StreamingQuery:
    """Run the batches named in the lines of new files of a folder, each file once; ends when none is left.

    Batches that arrive together run in the order of the calendar, `batches`: an older one after a
    newer one would lose its changes. One that the calendar doesn't have runs last, and fails.

    The stream's checkpoint remembers the files. A batch is run again if its run was cut off,
    which is safe as running a batch again changes nothing.
    """

    place = {b: k for k, b in enumerate(batches)}

    def each(df: DataFrame, _: int) -> None:
        named = {r["batch_id"] for r in df.selectExpr("trim(value) AS batch_id").where("batch_id <> ''").distinct().collect()}
        for batch_id in sorted(named, key=lambda b: (place.get(b, len(place)), b)):
            run(batch_id)

    stream = spark.readStream.text(folder)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
