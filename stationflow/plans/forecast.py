"""Hourly busyness forecasts for the coming days, and what a viewer asks of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.functions import bands
from stationflow.functions.holidays import holiday_calendar
from stationflow.functions.names import borough_from_flags
from stationflow.functions.timeparts import dow_sunday0, ntz
from stationflow.operators.features import add_holiday_features, add_time_features
from stationflow.operators.lookups import nested, profile_maps
from stationflow.operators.stations import best_names
from stationflow.schema import FEATURE_COLS, STATION, STATION_FEATURES, TS
from stationflow.session import materialise
from stationflow.sources.sinks import write_json


def forecast_features(
    stations: DataFrame, lookup: DataFrame, start_date: str, days: int = 90, calendar: DataFrame | None = None
) -> DataFrame:
    """One row of model features per station and hour to come.

    Lags are looked up in the station's weekly profile, joined once per station
    before its hours are laid out: the previous hour of the same weekday, the
    same hour of the day before, and the same cell. The rolling features are
    proxies as well: the weekday's mean, the overall mean and the population
    deviation of the profile. What a profile lacks counts as 0.
    """
    first_year = int(start_date[:4])
    if calendar is None:
        calendar = holiday_calendar(stations.sparkSession, first_year, first_year + days // 365 + 1)
    start = ntz(start_date)
    hours = F.sequence(start, start + F.make_dt_interval(F.lit(days - 1), F.lit(23)), F.expr("INTERVAL 1 HOUR"))
    laid_out = (
        stations.select(STATION, *STATION_FEATURES)
        .join(profile_maps(lookup), STATION, "left")
        .select("*", F.explode(hours).alias(TS))
    )
    dow, hour = dow_sunday0(F.col(TS)), F.hour(TS)

    def cell(day, at):
        return F.coalesce(F.try_element_at(F.col("cells"), day * 24 + at), F.lit(0.0))

    with_lags = laid_out.select(
        STATION, TS, *STATION_FEATURES,
        cell(dow, (hour + 23) % 24).alias("lag_1"),
        cell((dow + 6) % 7, hour).alias("lag_24"),
        cell(dow, hour).alias("lag_168"),
        F.coalesce(F.try_element_at("dow_means", dow), F.lit(0.0)).alias("roll_mean_24"),
        F.coalesce("overall_mean", F.lit(0.0)).alias("roll_mean_168"),
        F.coalesce("overall_std", F.lit(0.0)).alias("roll_std_24"),
    )
    return add_holiday_features(add_time_features(with_lags), calendar).select(STATION, TS, *FEATURE_COLS)


def run_forecast(
    stations: DataFrame, lookup: DataFrame, thresholds: DataFrame, scorer: Callable[[DataFrame], DataFrame],
    start_date: str, days: int = 90, calendar: DataFrame | None = None,
) -> DataFrame:
    """Probability per station, date and hour.

    Stations without a threshold were not trained on and are left out. Names
    are settled before any hour is laid out, on the list of stations alone; they are used twice and written once.
    """
    known = materialise(thresholds.select(STATION), "known")
    trained = stations.join(known, STATION, "left_semi")
    names = materialise(best_names(trained, known), "names")
    kept = trained.join(names, F.col(STATION) == F.col("_source"), "left_semi")
    scores = scorer(forecast_features(kept, lookup, start_date, days, calendar))
    return scores.join(names, F.col(STATION) == F.col("_source")).select(
        F.col("_name").alias("station"),
        F.col(TS).cast("date").alias("date"),
        F.hour(TS).alias("hour"),
        F.bround("predicted_prob", 3).alias("prob"),
    )


def forecast_meta(stations: DataFrame, forecast: DataFrame) -> DataFrame:
    """Borough and tier of the stations that were forecast."""
    meta = stations.select(F.col(STATION).alias("station"), borough_from_flags().alias("borough"), F.col("station_tier").alias("tier"))
    return meta.join(forecast.select("station").distinct(), "station", "left_semi")


def nest_forecast(forecast: DataFrame) -> DataFrame:
    """Export form: one row per station with {date: {hour: prob}}; its size is set by the days ahead."""
    days = nested(forecast, ["station", "date"], "hour", F.col("prob"), "hours")
    return nested(days, ["station"], "date", F.col("hours"), "dates")


def forecast_info(forecast: DataFrame, generated_at: str) -> DataFrame:
    """One row about a forecast run; the caller says when it was made."""
    return forecast.agg(
        F.lit(generated_at).alias("generated_at"),
        F.countDistinct("date").alias("days_ahead"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.countDistinct("station").alias("stations"),
    )


def export_forecast(forecast: DataFrame, stations: DataFrame, path: str, generated_at: str) -> None:
    """Write predictions, station meta and run info as JSON-lines folders.

    The forecast is written once as a table, which the three parts read.
    """
    stored = materialise(forecast, "forecast")
    write_json(nest_forecast(stored), f"{path}/predictions")
    write_json(forecast_meta(stations, stored), f"{path}/meta")
    write_json(forecast_info(stored, generated_at), f"{path}/info")


def quietest_hour(forecast: DataFrame, reach: int = 2) -> DataFrame:
    """For each hour the quietest one within `reach` hours of it on that day.

    The hour itself wins ties, then the earliest.
    """
    near = Window.partitionBy("station", "date").orderBy("hour").rangeBetween(-reach, reach)
    options = F.collect_list(F.struct("prob", "hour")).over(near)
    best = F.array_min(
        F.transform(
            F.col("_near"), lambda o: F.struct(o["prob"], (o["hour"] != F.col("hour")).cast("int"), o["hour"].alias("at"))
        )
    )
    found = forecast.withColumn("_near", options).withColumn("_best", best)
    return found.select("station", "date", "hour", "prob", F.col("_best.at").alias("best_hour"), F.col("_best.prob").alias("best_prob"))


def with_busyness(forecast: DataFrame) -> DataFrame:
    p = F.col("prob")
    return forecast.withColumns(
        {"level": bands.busyness_level(p), "label": bands.busyness_label(p), "percent": bands.percent_text(p)}
    )


def next_days(forecast: DataFrame, station: str, hour: int, start_date: str, days: int = 14) -> DataFrame:
    """One station and hour over the coming days; days without a forecast show no data."""
    first = F.lit(start_date).cast("date")
    spine = forecast.sparkSession.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    picked = forecast.where(
        (F.col("station") == station) & (F.col("hour") == hour)
        & F.col("date").between(first, F.date_add(first, days - 1))
    ).select("date", "prob")
    return with_busyness(spine.join(picked, "date", "left")).orderBy("date")
