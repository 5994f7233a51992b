"""Weekly profiles that stand in for lags when looking far ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions.timeparts import dow_sunday0
from stationflow.operators.rollups import hourly_ridership
from stationflow.schema import RIDERSHIP, STATION, TS
from stationflow.sources.facts import in_years, with_coordinates


def lag_lookup(df: DataFrame, year: int = 2023) -> DataFrame:
    """Mean hourly ridership per station, weekday (0 = Sunday) and hour, in that order: 168 cells a station."""
    hourly = hourly_ridership(with_coordinates(in_years(df, year)))
    return hourly.groupBy(STATION, dow_sunday0(F.col(TS)).alias("dow"), F.hour(TS).alias("hour")).agg(
        F.avg(RIDERSHIP).alias("avg_ridership")
    ).orderBy(STATION, "dow", "hour")


def weekday_means(lookup: DataFrame) -> DataFrame:
    return lookup.groupBy(STATION, "dow").agg(F.avg("avg_ridership").alias("dow_mean"))


def station_averages(lookup: DataFrame) -> DataFrame:
    """Mean and population deviation of all cells of a station."""
    return lookup.groupBy(STATION).agg(
        F.avg("avg_ridership").alias("overall_mean"), F.stddev_pop("avg_ridership").alias("overall_std")
    )


def profile_maps(lookup: DataFrame) -> DataFrame:
    """One row per station: its cells as a map (dow * 24 + hour -> mean), weekday
    means as a map, overall mean and deviation. A station has at most 168 cells."""
    cells = lookup.groupBy(STATION).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("dow") * 24 + F.col("hour"), F.col("avg_ridership")))).alias("cells"),
        F.avg("avg_ridership").alias("overall_mean"),
        F.stddev_pop("avg_ridership").alias("overall_std"),
    )
    days = weekday_means(lookup).groupBy(STATION).agg(
        F.map_from_entries(F.collect_list(F.struct("dow", "dow_mean"))).alias("dow_means")
    )
    return cells.join(days, STATION)


def nested(df: DataFrame, by: list[str], key: str, value: Column, name: str) -> DataFrame:
    """Collect (key, value) pairs per group into a map with text keys, in key
    order; for groups whose size has a fixed bound."""
    pairs = F.array_sort(
        F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))),
        lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0),
    )
    entries = F.transform(pairs, lambda p: F.struct(p["k"].cast("string"), p["v"]))
    return df.groupBy(*by).agg(F.map_from_entries(entries).alias(name))


def nest_lookup(lookup: DataFrame, digits: int = 2) -> DataFrame:
    """Export form: one row per station with {weekday: {hour: mean}}."""
    hours = nested(lookup, [STATION, "dow"], "hour", F.bround("avg_ridership", digits), "hours")
    return nested(hours, [STATION], "dow", F.col("hours"), "dows")


def unnest_lookup(exported: DataFrame) -> DataFrame:
    """Back from the export form to one row per cell."""
    days = exported.select(STATION, F.explode("dows").alias("dow", "_hours"))
    cells = days.select(STATION, "dow", F.explode("_hours").alias("hour", "avg_ridership"))
    return cells.withColumns({"dow": F.col("dow").cast("int"), "hour": F.col("hour").cast("int")})
