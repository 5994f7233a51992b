"""From the fact to feature matrices and scored evaluation frames.

The order matters and is kept: features per month, incomplete rows dropped,
then labels over what is left of each station.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from stationflow.functions.holidays import holiday_calendar
from stationflow.functions.timeparts import month_floor
from stationflow.operators.features import add_holiday_features, add_lag_features, add_time_features, drop_incomplete
from stationflow.operators.labels import congestion_thresholds, label_marked, mark_ahead
from stationflow.operators.rollups import hourly_ridership
from stationflow.operators.stations import merge_station_features
from stationflow.schema import TARGET_COL
from stationflow.session import materialise
from stationflow.sources.facts import only_stations


def build_features(
    ridership: DataFrame, start: str, end: str, stations: DataFrame, calendar: DataFrame | None = None,
    sample_stations=None, reset_by: str | None = "month", horizon: int | None = None, **lag_options,
) -> DataFrame:
    """The feature matrix of every station over [start, end), in one job.

    With `horizon` it also has the marks that `label_marked` needs, made in the window of the lags.

    `stations` is the saved station feature table. With `reset_by="month"` lags
    start anew each month, so a month's first 168 rows per station drop out.
    """
    calendar = calendar if calendar is not None else default_calendar(ridership, start, end)
    hourly = hourly_ridership(ridership, start=start, end=end)
    if sample_stations is not None:
        hourly = only_stations(hourly, sample_stations)
    if reset_by == "month":  # one column for both windows over it, so that they share a shuffle
        hourly, reset_by = hourly.withColumn("_month", month_floor(F.col("transit_timestamp"))), "_month"
    lagged = add_lag_features(add_time_features(hourly), reset_by=reset_by, **lag_options)
    made = [c for c in lagged.columns if c.startswith(("lag_", "roll_"))]
    complete = drop_incomplete(lagged, made)
    if horizon is not None:
        complete = mark_ahead(complete, horizon, month="_month" if reset_by == "_month" else None)
    complete = complete.drop("_month")
    return merge_station_features(add_holiday_features(complete, calendar), stations)


def default_calendar(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rule-based holidays for the years a range touches, with a year either side."""
    return holiday_calendar(df.sparkSession, int(start[:4]) - 1, int(end[:4]) + 1)


def build_training_data(
    ridership: DataFrame, stations: DataFrame, train_year: int = 2023, test_year: int = 2024, threshold: float = 0.8,
    horizon: int = 2, calendar: DataFrame | None = None, **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled training and test frames, and the training thresholds.

    The feature matrix feeds thresholds, both labels and the model, so it is
    written once. Thresholds come from the training year only.
    """
    start, end = f"{train_year}-01-01", f"{test_year + 1}-01-01"
    features = materialise(build_features(ridership, start, end, stations, calendar, horizon=horizon, **options), "features")
    train, test = (features.where(F.year("transit_timestamp") == y) for y in (train_year, test_year))
    limits = materialise(congestion_thresholds(train, threshold), "thresholds")
    return label_marked(train, limits, horizon), label_marked(test, limits, horizon), limits


def evaluation_set(
    ridership: DataFrame, stations: DataFrame, thresholds: DataFrame, start: str = "2025-01-01", end: str = "2026-03-01",
    horizon: int = 2, calendar: DataFrame | None = None, **options,
) -> DataFrame:
    """Labelled later months on saved thresholds; `end` is exclusive."""
    features = materialise(build_features(ridership, start, end, stations, calendar, horizon=horizon, **options), "features")
    return label_marked(features, thresholds, horizon)


def scored(df: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add the scorer's `predicted_prob`, the 0.5 cut and the actual label."""
    out = scorer(df)
    if "predicted" not in out.columns:
        out = out.withColumn("predicted", (F.col("predicted_prob") >= 0.5).cast("int"))
    return out.withColumn("actual", F.col(TARGET_COL))
