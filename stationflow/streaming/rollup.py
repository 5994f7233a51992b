"""The hourly rollup over a stream: final hours appended, or every hour kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions.timeparts import hour_floor
from stationflow.schema import RIDERSHIP, STATION, TS
from stationflow.session import materialise
from stationflow.sources.commits import commit_months, committed, read_committed
from stationflow.sources.facts import partition_keys


def hourly_stream(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Ridership per station and hour; an hour is final once `delay` has passed.

    Event-time watermarks need a zoned timestamp, so wall-clock time is read in
    the session's zone, which should be UTC, and given back without zone.
    """
    timed = stream.withColumn("_event_time", F.col(TS).cast("timestamp")).withWatermark("_event_time", delay)
    return (
        timed.groupBy(F.window("_event_time", "1 hour").alias("_window"), STATION)
        .agg(F.sum(RIDERSHIP).cast("double").alias(RIDERSHIP))
        .select(F.col("_window.start").cast("timestamp_ntz").alias(TS), STATION, RIDERSHIP)
    )


def start_hourly(hourly: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append final hours to a table."""
    writer = (
        hourly.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_hourly_upserts(stream: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keep a table of all hours up to date; `hourly_table` reads it.

    Each micro-batch is summed by hour and station and added to the stored sums of the months it
    touches, as one commit named after the batch: a repeated batch is not added twice, and
    readers see it whole or not at all. Open hours hold what has come so far, and a record that comes late, however late,
    still counts; so there is no watermark and no state beyond the table. What a batch costs besides its rows are the
    station-hours of its months. `checkpoint` belongs to `root`: start both anew together.
    """

    def add(batch: DataFrame, number: int) -> None:
        commit = f"batch-{number:09d}"
        if committed(batch.sparkSession, root, commit):
            return
        sums = batch.groupBy(hour_floor(F.col(TS)).alias(TS), STATION).agg(F.sum(RIDERSHIP).alias(RIDERSHIP))
        sums = materialise(sums, "hours")
        months = partition_keys(sums).select("year", "month").distinct()
        stored = _stored(sums, root).join(months, ["year", "month"], "left_semi").select(TS, STATION, RIDERSHIP)
        merged = stored.unionByName(sums).groupBy(TS, STATION).agg(F.sum(RIDERSHIP).cast(sums.schema[RIDERSHIP].dataType).alias(RIDERSHIP))
        commit_months(merged, root, commit)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _stored(sums: DataFrame, root: str) -> DataFrame:
    return read_committed(sums.sparkSession, root, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sums.schema.fields))


def hourly_table(stream: DataFrame, root: str) -> DataFrame:
    """The table of `start_hourly_upserts` as of now; `stream` tells the types."""
    kind = stream.select(F.col(TS).cast("timestamp_ntz").alias(TS), STATION, RIDERSHIP).groupBy(TS, STATION).agg(F.sum(RIDERSHIP).alias(RIDERSHIP))
    return _stored(kind, root).select(TS, STATION, F.col(RIDERSHIP).cast("double").alias(RIDERSHIP))
