"""Reading the `ridership` fact and filtering it by station and time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from stationflow.functions.timeparts import ntz
from stationflow.schema import PARTITION_COLS, STATION, TS, fact_schema


def read_ridership(
    spark: SparkSession, roots: str | list[str], schema: StructType | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Scan year/month-partitioned Parquet. Several roots (say a backfilled
    history and a live feed) are read as one table."""
    roots = [roots] if isinstance(roots, str) else roots
    full = StructType(list((schema or fact_schema(extra)).fields))
    for name in PARTITION_COLS:
        full = full.add(name, IntegerType())
    names = full.fieldNames()

    def scan(root: str) -> DataFrame:
        return spark.read.schema(full).option("recursiveFileLookup", "false").parquet(root).select(*names)

    return reduce(DataFrame.unionByName, [scan(root) for root in roots])


def register_ridership(spark: SparkSession, roots: str | list[str], view: str = "ridership", **kwargs) -> DataFrame:
    """Scan and publish as a temporary view for SQL users."""
    df = read_ridership(spark, roots, **kwargs)
    df.createOrReplaceTempView(view)
    return df


def partition_keys(df: DataFrame, ts: str = TS) -> DataFrame:
    """Add the `year` and `month` partition columns."""
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def distinct_months(df: DataFrame) -> DataFrame:
    return df.select(*PARTITION_COLS).distinct()


def _month_bound(at: str | Column, lower: bool, before_midnight: bool) -> Column:
    moment = ntz(at)
    if before_midnight:
        moment = moment - F.expr("INTERVAL '0.000001' SECOND")
    year, month = F.year(moment), F.month(moment)
    if lower:
        return (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))
    return (F.col("year") < year) | ((F.col("year") == year) & (F.col("month") <= month))


def select_range(
    df: DataFrame, station: str | None = None, start: str | None = None, end: str | None = None,
    ts: str = TS, station_col: str = STATION,
) -> DataFrame:
    """Optional filters: one station, `start` inclusive, `end` exclusive.

    On a frame with `year` and `month` columns the range also filters those, so
    that a scan skips the partitions outside it.
    """
    partitioned = set(PARTITION_COLS) <= set(df.columns)
    if station is not None:
        df = df.where(F.col(station_col) == station)
    if start is not None:
        df = df.where(F.col(ts) >= ntz(start))
        if partitioned:
            df = df.where(_month_bound(start, lower=True, before_midnight=False))
    if end is not None:
        df = df.where(F.col(ts) < ntz(end))
        if partitioned:
            df = df.where(_month_bound(end, lower=False, before_midnight=True))
    return df


def in_years(df: DataFrame, *years: int, ts: str = TS) -> DataFrame:
    """Rows of the given years, by partition column where the frame has one."""
    year = F.col("year") if "year" in df.columns else F.year(ts)
    return df.where(year.isin(*years))


def with_coordinates(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull())


def only_stations(df: DataFrame, stations: list[str] | DataFrame, station_col: str = STATION) -> DataFrame:
    """Keep a sample of stations, given as a short list or a table."""
    if isinstance(stations, DataFrame):
        return df.join(stations.select(station_col), station_col, "left_semi")
    return df.where(F.col(station_col).isin(*stations))
