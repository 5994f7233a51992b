"""Partitioned writes and the high-water mark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.functions.timeparts import iso_text
from stationflow.schema import BATCH_COL, PARTITION_COLS, STATION, TS
from stationflow.sources.facts import partition_keys


def balanced(df: DataFrame) -> DataFrame:
    """Ask for even output files per month: small months are merged into one
    file, a month with a large share of the rows is split over many tasks."""
    return df.hint("rebalance", *PARTITION_COLS)


def by_station(df: DataFrame) -> DataFrame:
    """Months laid out by station: each task has a range of one month's stations in order, a busy station's rows are split by time."""
    return df.repartitionByRange(*PARTITION_COLS, STATION, TS).sortWithinPartitions(*PARTITION_COLS, STATION, TS)


def replace_months(df: DataFrame, root: str, station_layout: bool = False) -> None:
    """Write year/month partitions; each month in `df` is replaced, others stay.
    An empty frame writes nothing.

    With `station_layout` rows are in order of station inside a month, and row groups carry a Bloom filter over the
    station: a scan for one station passes over the row groups of others, and with a range over those of other times.
    """
    keyed = partition_keys(df)
    (
        (by_station(keyed) if station_layout else balanced(keyed))
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{STATION}", str(station_layout).lower())
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS)
        .parquet(root)
    )


def append_months(df: DataFrame, root: str, batch: str | None = None) -> None:
    """Add rows to year/month partitions without reading what is there.

    With `batch` the rows go to a folder of that name inside each month and a
    repeated write of the same batch replaces itself, so a retry after a crash
    adds nothing twice. Use one style per root.
    """
    keyed = partition_keys(df)
    if batch is None:
        balanced(keyed).write.mode("append").partitionBy(*PARTITION_COLS).parquet(root)
        return
    (
        balanced(keyed.withColumn(BATCH_COL, F.lit(batch)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS, BATCH_COL)
        .parquet(root)
    )


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def newest_in_batch(spark: SparkSession, root: str, batch: str) -> str | None:
    """The newest timestamp written under a batch name; reads that batch's one column."""
    schema = f"{TS} timestamp_ntz, year int, month int, {BATCH_COL} string"
    stored = spark.read.schema(schema).parquet(root).where(F.col(BATCH_COL) == batch)
    return stored.agg(F.max(iso_text(F.col(TS)))).first()[0]


# --- high-water mark ---------------------------------------------------------------
_CONTROL = "seq long, last_timestamp string"


def _latest(spark: SparkSession, control: str):
    try:
        rows = spark.read.schema(_CONTROL).parquet(control)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.agg(F.max("seq").alias("seq"), F.max_by("last_timestamp", "seq").alias("ts")).first()


def get_watermark(spark: SparkSession, control: str) -> str | None:
    """The last timestamp taken in, or None on the first run."""
    row = _latest(spark, control)
    return None if row is None else row["ts"]


def set_watermark(spark: SparkSession, control: str, timestamp: str) -> None:
    """Append the new mark; earlier marks stay, so a crash never loses it."""
    row = _latest(spark, control)
    seq = 0 if row is None or row["seq"] is None else row["seq"] + 1
    spark.createDataFrame([(seq, timestamp)], _CONTROL).coalesce(1).write.mode("append").parquet(control)
