"""Continuous ingest of landed pages with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.schema import PARTITION_COLS, TS, landed_schema
from stationflow.sources.facts import partition_keys
from stationflow.sources.landed import clean


def landed_stream(
    spark: SparkSession, path: str, extra: list[str] | None = None, lines: bool = False, max_files: int | None = None
) -> DataFrame:
    """New landed pages as they appear in a folder."""
    reader = (
        spark.readStream.schema(landed_schema(extra))
        .option("multiLine", str(not lines).lower())
        .option("mode", "FAILFAST")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def start_ingest(landed: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Clean and append to year/month partitions, each page exactly once.

    The checkpoint takes the place of the high-water mark: late pages count as
    new, a rerun adds nothing. With `once` it takes in what is there and ends.
    """
    writer = (
        partition_keys(clean(landed))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITION_COLS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def without_repeats(stream: DataFrame, keys: list[str], delay: str = "2 hours") -> DataFrame:
    """Drop records whose key was seen within the delay; older keys leave the state."""
    timed = stream.withColumn("_event_time", F.col(TS).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_event_time")
