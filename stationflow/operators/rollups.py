"""Grouped summaries of the ridership fact.

Two grains occur and are kept apart by name: `avg_ridership` of A-type
summaries is per source record, summaries of station-hours first sum records
to one value per station and hour. All group-bys are algebraic, so Spark
aggregates before it shuffles and a busy station costs no more than a quiet one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.functions.timeparts import day_name, dow_monday0, dow_sunday0, weekday_only
from stationflow.operators.quantiles import exact_quantiles
from stationflow.schema import BOROUGH, RIDERSHIP, STATION, STATION_ID, TS
from stationflow.sources.facts import in_years, select_range, with_coordinates


def _total(column: str = RIDERSHIP):
    return F.sum(column).cast("double")


def hourly_ridership(df: DataFrame, station=None, start=None, end=None, by: tuple[str, ...] = (TS, STATION)) -> DataFrame:
    """Ridership per station and hour, summed over payment methods."""
    return select_range(df, station, start, end).groupBy(*by).agg(_total().alias(RIDERSHIP))


def busiest_stations(df: DataFrame, start=None, end=None, limit: int = 10) -> DataFrame:
    return (
        select_range(df, None, start, end)
        .groupBy(STATION, BOROUGH)
        .agg(_total().alias("total_ridership"))
        .orderBy(F.desc("total_ridership"), STATION, BOROUGH)
        .limit(limit)
    )


def ridership_by_hour(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        select_range(df, None, start, end)
        .groupBy(F.hour(TS).alias("hour_of_day"))
        .agg(F.avg(F.col(RIDERSHIP).cast("double")).alias("avg_ridership"), _total().alias("total_ridership"))
        .orderBy("hour_of_day")
    )


def ridership_by_borough(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        select_range(df, None, start, end)
        .groupBy(BOROUGH)
        .agg(_total().alias("total_ridership"), F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("total_ridership"), BOROUGH)
    )


def ridership_by_day_of_week(df: DataFrame, start=None, end=None) -> DataFrame:
    return (
        select_range(df, None, start, end)
        .groupBy(
            dow_sunday0(F.col(TS)).alias("day_of_week"),
            day_name(F.col(TS)).alias("day_name"),
            F.hour(TS).alias("hour_of_day"),
        )
        .agg(F.avg(F.col(RIDERSHIP).cast("double")).alias("avg_ridership"))
        .orderBy("day_of_week", "hour_of_day")
    )


def station_profile(df: DataFrame, years: tuple[int, ...] = (2023, 2024)) -> DataFrame:
    """Level, spread and peak of each station's hourly ridership."""
    by = (STATION, STATION_ID, BOROUGH)
    hourly = hourly_ridership(in_years(df, *years), by=(*by, TS))
    return hourly.groupBy(*by).agg(
        F.avg(RIDERSHIP).alias("avg_ridership"),
        F.stddev_samp(RIDERSHIP).alias("std_ridership"),
        F.max(RIDERSHIP).alias("max_ridership"),
        F.countDistinct(F.trunc(F.col(TS).cast("date"), "month")).alias("months_of_data"),
    )


def station_coordinates(df: DataFrame, years: tuple[int, ...] = (2023, 2024)) -> DataFrame:
    return (
        with_coordinates(in_years(df, *years))
        .groupBy(STATION)
        .agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"))
    )


def average_day(df: DataFrame, year: int = 2025, weekdays: str = "tue_sat") -> DataFrame:
    """Mean record per station and hour over one year's weekdays, in that order."""
    return (
        with_coordinates(in_years(df, year))
        .where(weekday_only(F.col(TS), weekdays))
        .groupBy(STATION, F.hour(TS).alias("hour"))
        .agg(
            F.avg(F.col(RIDERSHIP).cast("double")).alias("avg_ridership"),
            F.avg("latitude").alias("lat"),
            F.avg("longitude").alias("lon"),
        )
        .orderBy(STATION, "hour")
    )


def week_slice(df: DataFrame, start: str, end: str) -> DataFrame:
    """Station-hours of a date range with their coordinates, in order of time and station."""
    return (
        with_coordinates(select_range(df, None, start, end))
        .groupBy(STATION, TS)
        .agg(_total().alias(RIDERSHIP), F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"))
        .orderBy(TS, STATION)
    )


def normaliser(day: DataFrame, q: float = 0.95) -> DataFrame:
    """One row `ceiling`: the q-quantile of the average-day cells."""
    return exact_quantiles(day, [], "avg_ridership", [q], ["ceiling"])


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(STATION).alias("stations"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
    )


def weekday_spread(hourly: DataFrame) -> DataFrame:
    """Minimum, quartiles and maximum of hourly ridership per weekday (0 = Monday)."""
    tagged = hourly.withColumn("day_of_week", dow_monday0(F.col(TS)))
    return exact_quantiles(
        tagged, ["day_of_week"], RIDERSHIP, [0, 0.25, 0.5, 0.75, 1],
        ["min", "q1", "median", "q3", "max"],
    )


def hour_weekday_matrix(df: DataFrame, value: str) -> DataFrame:
    """Mean of `value` with weekdays as rows and the 24 hours as columns."""
    tagged = df.select(
        dow_monday0(F.col(TS)).alias("day_of_week"), F.hour(TS).alias("_hour"), F.col(value).cast("double").alias("_v")
    )
    grid = tagged.groupBy("day_of_week").pivot("_hour", list(range(24))).agg(F.avg("_v"))
    return grid.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)]).orderBy("day_of_week")


def densify_hours(hourly: DataFrame) -> DataFrame:
    """Add the missing hours between each station's first and last, with NULL ridership."""
    span = hourly.groupBy(STATION).agg(F.min(TS).alias("_a"), F.max(TS).alias("_b"))
    spine = span.select(STATION, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 HOUR"))).alias(TS))
    return spine.join(hourly, [STATION, TS], "left")
