"""Tables for the station map and the ridership animation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.functions import bands
from stationflow.functions.names import borough_from_flags
from stationflow.operators.evaluate import roc_auc
from stationflow.operators.lookups import nested
from stationflow.operators.rollups import average_day, normaliser, station_coordinates, week_slice
from stationflow.operators.stations import all_lines, station_meta
from stationflow.schema import RIDERSHIP, STATION, TARGET_COL, TS
from stationflow.session import materialise
from stationflow.sources.sinks import write_json


def station_map(ridership: DataFrame, train: DataFrame, scored: DataFrame, stations: DataFrame, years=(2023, 2024)) -> DataFrame:
    """One record per station with coordinates: rate, drift, AUC, size.

    Every part is one grouped pass over its frame, joined at station grain.
    `scored` is read twice, so pass a written table. Stations without
    coordinates are left out; a missing drift counts as 0.
    """
    rates = scored.groupBy(STATION).agg(
        F.avg("actual").alias("rate"), F.max("num_lines").alias("num_lines"), F.max("station_tier").alias("station_tier")
    )
    before = train.groupBy(STATION).agg(F.avg(TARGET_COL).alias("train_rate"))
    aucs = roc_auc(scored, [STATION]).select(STATION, "auc")
    boroughs = stations.select(STATION, borough_from_flags().alias("borough")).groupBy(STATION).agg(F.min("borough").alias("borough"))
    return (
        rates.join(station_coordinates(ridership, years), STATION)
        .join(before, STATION, "left")
        .join(aucs, STATION, "left")
        .join(boroughs, STATION, "left")
        .withColumn("drift", F.col("rate") - F.col("train_rate"))
        .select(
            F.col(STATION).alias("name"),
            F.bround("lat", 5).alias("lat"),
            F.bround("lon", 5).alias("lon"),
            F.bround("rate", 4).alias("congestion_rate"),
            F.bround(F.coalesce("drift", F.lit(0.0)), 4).alias("drift"),
            F.bround("auc", 4).alias("auc"),
            "num_lines",
            "station_tier",
            F.coalesce("borough", F.lit("Unknown")).alias("borough"),
        )
    )


def map_details(records: DataFrame) -> DataFrame:
    """Colour positions, marker radius and texts of the map's records."""
    rate, drift, auc = F.col("congestion_rate"), F.col("drift"), F.col("auc")
    return records.withColumns(
        {
            "rate_position": bands.rate_position(rate),
            "drift_position": bands.drift_position(drift),
            "auc_position": bands.auc_position(auc),
            "radius": F.col("station_tier") * 1.5 + 4,
            "rate_text": bands.rate_text(rate),
            "drift_text": bands.drift_text(drift),
            "auc_text": bands.auc_text(auc),
        }
    )


def export_map(stations: DataFrame, path: str) -> None:
    """Write the records of `station_map` as JSON lines, missing values kept."""
    write_json(stations, path)


def animation_daily(ridership: DataFrame, year: int = 2025, weekdays: str = "tue_sat") -> DataFrame:
    """Average day per station and hour: `r` ridership per record, `n` relative
    to the 95th percentile of all cells (may exceed 1)."""
    day = materialise(average_day(ridership, year, weekdays), "day")  # the quantile reads it again
    ceiling = normaliser(day).scalar()
    return day.withColumn("_ceiling", ceiling).select(
        STATION, "hour",
        F.bround("lat", 5).alias("lat"), F.bround("lon", 5).alias("lon"),
        F.bround("avg_ridership", 1).alias("r"),
        F.bround(bands.safe_ratio(F.col("avg_ridership"), F.col("_ceiling")), 4).alias("n"),
    )


def animation_week(ridership: DataFrame, year: int = 2025, start: str = "2025-10-06", end: str = "2025-10-13", weekdays: str = "tue_sat") -> DataFrame:
    """One week of station-hours on the same scale as the average day, at most 1."""
    ceiling = normaliser(materialise(average_day(ridership, year, weekdays), "day")).scalar()
    share = bands.safe_ratio(F.col(RIDERSHIP), F.col("_ceiling"))
    return week_slice(ridership, start, end).withColumn("_ceiling", ceiling).select(
        TS, STATION,
        F.bround(RIDERSHIP, 1).alias("r"),
        F.bround(F.least(F.lit(1.0), share), 4).alias("n"),
    )


def nest_daily(daily: DataFrame) -> DataFrame:
    """One row per station with its 24 hours as a map."""
    return nested(daily, [STATION, "lat", "lon"], "hour", F.struct("r", "n"), "hours")


def export_animation(ridership: DataFrame, stations: DataFrame, path: str, **options) -> None:
    """Write the four parts as JSON-lines folders, each in parallel."""
    meta = station_meta(stations)
    daily_options = {k: v for k, v in options.items() if k in ("year", "weekdays")}
    write_json(nest_daily(animation_daily(ridership, **daily_options)), f"{path}/daily")
    write_json(animation_week(ridership, **options), f"{path}/week")
    write_json(meta, f"{path}/meta")
    write_json(all_lines(meta), f"{path}/all_lines")
