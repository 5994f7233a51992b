"""Features and labels: row-based lags, month resets, label edges, holidays."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.functions import holidays
from stationflow.operators.features import add_holiday_features, add_lag_features, add_time_features, drop_incomplete
from stationflow.operators.labels import add_congestion_label, congestion_thresholds, following_rows, label_marked, mark_ahead
from stationflow.operators.ordered import number_rows
from stationflow.schema import TIME_FEATURES
from stationflow.session import materialise


def series(name, values, start="2024-01-01T00:00:00", step=1):
    first = pd.Timestamp(start)
    return [(name, (first + pd.Timedelta(hours=i * step)).isoformat(), float(v)) for i, v in enumerate(values)]


def by_time(df, *columns):
    return [tuple(r) for r in df.orderBy("station_complex", "transit_timestamp").select(*columns).collect()]


@pytest.mark.parametrize("chunk_rows", [None, 3, 50_000])
def test_label_reaches_threshold_and_tail_is_zero(spark, hours, chunk_rows):
    limits = spark.createDataFrame([("A", 3.0)], "station_complex string, threshold double")
    df = add_congestion_label(hours(series("A", [1, 2, 3, 4, 5])), thresholds=limits, chunk_rows=chunk_rows)
    assert by_time(df, "is_congested") == [(1,), (1,), (1,), (0,), (0,)]


def test_label_tail_can_be_dropped(spark, hours):
    limits = spark.createDataFrame([("A", 3.0)], "station_complex string, threshold double")
    df = add_congestion_label(hours(series("A", [1, 2, 3, 4, 5])), thresholds=limits, tail="drop", chunk_rows=2)
    assert by_time(df, "is_congested") == [(1,), (1,), (1,)]


def test_unknown_station_is_never_busy(spark, hours):
    limits = spark.createDataFrame([("B", 0.0)], "station_complex string, threshold double")
    df = add_congestion_label(hours(series("A", [1, 2, 3, 4])), thresholds=limits)
    assert by_time(df, "is_congested") == [(0,)] * 4


def test_thresholds_do_not_depend_on_labelled_rows(spark, hours):
    train = hours(series("A", [1, 2, 4, 9]))
    limits = congestion_thresholds(train)
    assert limits.first()["threshold"] == pytest.approx(6.0, abs=1e-9)
    few = add_congestion_label(hours(series("A", [9, 9, 9])), thresholds=limits)
    assert by_time(few, "is_congested") == [(1,), (0,), (0,)]


def test_lags_count_rows_not_hours(hours):
    rows = [("A", f"2024-01-01T0{h}:00:00", float(h)) for h in (0, 1, 3)]
    df = add_lag_features(hours(rows), lags=(1,), mean_windows=(2,), std_windows=(2,))
    assert by_time(df, "lag_1") == [(None,), (0.0,), (1.0,)]


def test_lags_start_anew_each_month_on_request(hours):
    rows = series("A", [1, 2, 3, 4], start="2024-01-31T22:00:00")
    options = dict(lags=(1,), mean_windows=(2,), std_windows=(2,))
    assert by_time(add_lag_features(hours(rows), reset_by="month", **options), "lag_1") == [(None,), (1.0,), (None,), (3.0,)]
    assert by_time(add_lag_features(hours(rows), **options), "lag_1") == [(None,), (1.0,), (2.0,), (3.0,)]


def test_label_crosses_the_rows_dropped_between_months(spark, hours):
    rows = series("A", [1, 1, 1, 1], start="2024-01-31T20:00:00") + series("A", [1, 1, 7, 8], start="2024-02-01T00:00:00")
    options = dict(lags=(2,), mean_windows=(2,), std_windows=(2,), reset_by="month")
    kept = drop_incomplete(add_lag_features(hours(rows), **options), ["lag_2"])
    limits = spark.createDataFrame([("A", 7.0)], "station_complex string, threshold double")
    df = add_congestion_label(kept, thresholds=limits)
    # two rows of each month are left; January's see February's first kept rows
    assert by_time(df, "ridership", "is_congested") == [(1.0, 1), (1.0, 1), (7.0, 0), (8.0, 0)]


@pytest.mark.parametrize("horizon,tail", [(1, "zero"), (2, "zero"), (5, "drop")])
def test_label_over_sparse_months_equals_a_plain_window(spark, hours, horizon, tail):
    """Months with fewer rows than the horizon, and empty ones, between full ones."""
    rng = np.random.default_rng(horizon)
    rows = []
    for name in "ABC":
        for month, n in enumerate(rng.choice([0, 1, 1, 2, 3, 9], 14)):
            at = sorted(rng.choice(28 * 24, n, replace=False))
            rows += [(name, (pd.Timestamp(2023 + month // 12, month % 12 + 1, 1) + pd.Timedelta(hours=int(h))).isoformat(), None if rng.random() < 0.1 else float(rng.integers(9))) for h in at]
    df = hours(rows).withColumn("extra", F.lit("x"))
    limits = spark.createDataFrame([("A", 4.0), ("B", 7.0)], "station_complex string, threshold double")
    got = by_time(add_congestion_label(df, thresholds=limits, horizon=horizon, tail=tail), "station_complex", "ridership", "extra", "is_congested")
    plain = by_time(add_congestion_label(df, thresholds=limits, horizon=horizon, tail=tail, chunk_rows=1000), "station_complex", "ridership", "extra", "is_congested")
    assert got == plain and len(got) > 50


def test_labels_of_marked_rows_shuffle_no_features(hours, tmp_path):
    monthly = hours(series("A", range(800))).withColumn("m", F.trunc(F.col("transit_timestamp").cast("date"), "month"))
    df = add_lag_features(monthly, reset_by="m", lags=(1,), mean_windows=(2,), std_windows=(2,))
    path = f"{tmp_path}/features"
    marked = mark_ahead(drop_incomplete(df, ["lag_1"]), 2, month="m")
    assert marked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # that of the lags
    marked.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    limits = materialise(congestion_thresholds(stored), "thresholds")
    plan = label_marked(stored, limits, 2)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    heads = following_rows(stored, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in heads and "lag_1" not in heads


@pytest.mark.parametrize("chunk_rows", [None, 170, 1000])
def test_lag_features_equal_pandas(spark, hours, chunk_rows):
    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("A", 700), ("B", 90), ("C", 9), ("D", 400)):
        keep = rng.random(n) < 0.9
        values = rng.integers(0, 50, n).astype(float)
        rows += [r for r, k in zip(series(name, values), keep) if k]
    got = add_lag_features(hours(rows), chunk_rows=chunk_rows).toPandas()
    want = pd.DataFrame(rows, columns=["station_complex", "transit_timestamp", "ridership"])
    want["transit_timestamp"] = pd.to_datetime(want["transit_timestamp"])
    want = want.sort_values(["station_complex", "transit_timestamp"]).reset_index(drop=True)
    x = want.groupby("station_complex")["ridership"]
    for n in (1, 24, 168):
        want[f"lag_{n}"] = x.shift(n)
    for name, n, stat in (("roll_mean_24", 24, "mean"), ("roll_mean_168", 168, "mean"), ("roll_std_24", 24, "std")):
        want[name] = x.transform(lambda s: getattr(s.shift(1).rolling(n, min_periods=n // 2), stat)())
    got = got.sort_values(["station_complex", "transit_timestamp"]).reset_index(drop=True)[want.columns]
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-9)


def test_null_ridership_counts_as_missing_in_windows(hours):
    rows = [("A", f"2024-01-01T{h:02d}:00:00", v) for h, v in enumerate([1.0, None, 3.0, 5.0, 7.0])]
    df = add_lag_features(hours(rows), lags=(1,), mean_windows=(4,), std_windows=(4,), chunk_rows=4)
    assert by_time(df, "lag_1", "roll_mean_4") == [(None, None), (1.0, None), (None, None), (3.0, 2.0), (5.0, 3.0)]


def test_row_numbers_are_continuous_over_buckets(spark, hours):
    rows = series("A", range(100), step=7) + series(None, range(5))
    got = number_rows(hours(rows), ["station_complex"], "transit_timestamp", total="n").toPandas()
    a = got[got.station_complex == "A"].sort_values("transit_timestamp")
    assert a["_row"].tolist() == list(range(1, 101)) and set(a["n"]) == {100}
    assert sorted(got[got.station_complex.isna()]["_row"]) == [1, 2, 3, 4, 5]


def test_monthly_lag_plan_sorts_once_and_runs_no_python(hours):
    df = add_lag_features(hours(series("A", range(5))), reset_by="month")
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("Sort [") == 1 and "Python" not in initial


def test_time_features(hours):
    df = add_time_features(hours([("A", "2021-01-03T06:30:00", 1.0)]))
    row = df.first()
    assert [c for c in df.columns[3:]] == TIME_FEATURES
    assert (row.hour, row.day_of_week, row.month, row.week_of_year) == (6, 6, 1, 53)
    assert (row.is_weekend, row.is_shoulder_day, row.day_sun, row.day_mon) == (1, 0, 1, 0)
    assert row.hour_sin == pytest.approx(1.0) and row.hour_cos == pytest.approx(0.0, abs=1e-12)


def test_november_dates(spark):
    year = F.col("id").cast("int")
    rows = spark.range(2020, 2028).select(
        holidays.marathon_day(year).alias("m"), holidays.thanksgiving(year).alias("t"),
        holidays.pre_thanksgiving_saturday(year).alias("p8"), holidays.pre_thanksgiving_saturday(year, 5).alias("p5"),
    ).collect()
    assert [r.m.day for r in rows] == [1, 7, 6, 5, 3, 2, 1, 7]
    assert [r.t.day for r in rows] == [26, 25, 24, 23, 28, 27, 26, 25]
    assert all(r.p8 is None for r in rows)
    assert all(r.p5 == r.t - dt.timedelta(days=5) and r.p5.weekday() == 5 for r in rows)


def test_holiday_flags_around_a_given_calendar(spark, hours):
    calendar = spark.createDataFrame([(dt.date(2024, 7, 4),), (dt.date(2024, 7, 5),)], "date date")
    rows = [("A", f"2024-07-0{d}T12:00:00", 1.0) for d in range(2, 8)]
    df = add_holiday_features(hours(rows), calendar)
    assert by_time(df, "is_holiday", "is_holiday_eve", "is_holiday_next") == [
        (0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 1), (0, 0, 1), (0, 0, 0),
    ]
    assert df.count() == 6


def test_default_calendar(spark):
    days = {r.date for r in holidays.holiday_calendar(spark, 2021, 2022).collect()}
    federal = {r.date for r in holidays.holiday_calendar(spark, 2021, 2022, observed=False, new_york=False).collect()}
    assert len(federal) == 22
    assert dt.date(2021, 12, 31) in days and dt.date(2021, 12, 31) not in federal  # New Year 2022 is a Saturday
    assert {dt.date(2022, 2, 12), dt.date(2022, 2, 15), dt.date(2022, 11, 8)} <= days
    assert all(d.year in (2021, 2022) for d in days)
