"""Names, de-duplication, lookups, forecasts, exports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.functions import bands, names
from stationflow.functions.timeparts import hour_label, weekday_only
from stationflow.operators import evaluate, lookups, rollups, stations
from stationflow.plans import exports, forecast
from stationflow.schema import BOROUGH_FLAGS, FEATURE_COLS, STATION_FEATURES
from stationflow.sources.sinks import write_json


def frame(spark, rows, schema="station_complex string"):
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


@pytest.mark.parametrize(
    "name, count, letters, form",
    [
        ("Cross Av (N)/62 St (D)", 2, ["D", "N"], "Cross Av (N)/62 St (D)"),
        ("Plain Plaza", 1, [], "Plain Plaza"),
        ("Grand Central-42 St (S,4,5,6,7)", 5, ["4", "5", "6", "7", "S"], "Grand Central-42 St (4,5,6,7,S)"),
        ("Loop Rd (C, A)/9 St (Z,B)", 4, ["A", "B", "C", "Z"], "Loop Rd (A,C)/9 St (B,Z)"),
        ("Twice (A)/(A)", 2, ["A"], "Twice (A)/(A)"),
        ("Open (A", 1, [], "Open (A"),
    ],
)
def test_line_letters(spark, name, count, letters, form):
    n = F.col("station_complex")
    row = frame(spark, [name]).select(
        names.num_lines(n).alias("n"), names.lines(n).alias("l"), names.sort_line_letters(n).alias("f")
    ).first()
    assert (row.n, row.l, row.f) == (count, letters, form)


def test_terminal_is_contained_in_any_case(spark):
    df = frame(spark, ["x PELHAM BAY PARK (6) y", "Pelham Bay Park (5)", "28 Av (L)"])
    got = [r[0] for r in df.select(names.is_terminal(F.col("station_complex"))).collect()]
    assert got == [1, 0, 1]


@pytest.mark.parametrize("both", [["Alabama Av (J,Z)", "Alabama Av (J)"], ["Alabama Av (J)", "Alabama Av (J,Z)"]])
def test_canonical_rows_win_over_renamed(spark, both):
    df = frame(spark, [(b, b) for b in both], "station_complex string, v string")
    known = frame(spark, ["Alabama Av (J)"])
    assert [tuple(r) for r in stations.deduplicate_stations(df, known).collect()] == [("Alabama Av (J)",) * 2]


def test_renamed_alone_takes_the_canonical_name(spark):
    df = frame(spark, [("Alabama Av (J,Z)", 7)], "station_complex string, v int")
    assert [tuple(r) for r in stations.rename_stations(df).collect()] == [("Alabama Av (J)", 7)]


def test_known_then_longest_then_first_name_is_kept(spark):
    rows = ["A St (1,2)", "A St (2,1)", "B St (1, 2)", "B St (2,1)", "C St (2,1)", "C St (1,2)", "D St"]
    got = {r[0] for r in stations.deduplicate_stations(frame(spark, rows), frame(spark, ["A St (2,1)", "D St"])).collect()}
    assert got == {"A St (2,1)", "B St (1, 2)", "C St (1,2)", "D St"}


def test_search(spark):
    df = frame(spark, ["Park Pl", "Park", "Car Park", "Plaza"])
    first = lambda q: [r[0] for r in stations.find_station(df, q).collect()]
    assert first(" PARK ") == ["Park"] and first("par") == ["Car Park"] and first("zoo") == []
    assert stations.suggest_stations(df, "p").count() == 0
    assert [r[0] for r in stations.suggest_stations(df, "pa").collect()] == ["Car Park", "Park", "Park Pl"]


def test_filters(spark):
    rows = [("a", "Bronx", 1, 1, ["A"]), ("b", "Bronx", 3, 2, ["A", "B", "C"]), ("c", "Queens", 2, 2, ["C", "D"])]
    meta = spark.createDataFrame(rows, "station_complex string, borough string, num_lines int, station_tier int, lines array<string>")
    pick = lambda **k: {r[0] for r in stations.filter_stations(meta, **k).collect()}
    assert pick() == {"a", "b", "c"} and pick(borough="Bronx") == {"a", "b"} and pick(tier=2) == {"b", "c"}
    assert pick(line_count="3+") == {"b"} and pick(line_count="1") == {"a"} and pick(line="C", borough="Queens") == {"c"}


def test_merge_fans_out_for_repeated_names(spark):
    table = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "station_complex string, id string")
    wide = table.select("station_complex", *[F.lit(1).alias(c) for c in STATION_FEATURES])
    assert stations.merge_station_features(frame(spark, ["a", "b", "z"]), wide).count() == 4
    assert [tuple(r) for r in stations.repeated_names(table).collect()] == [("a", 2)]


def test_weekday_filter_keeps_tuesday_to_saturday(spark):
    days = spark.range(7).select(F.date_add(F.lit("2025-10-05").cast("date"), F.col("id").cast("int")).alias("d"))
    kept = lambda w: [r.d.strftime("%a") for r in days.where(weekday_only(F.col("d"), w)).orderBy("d").collect()]
    assert kept("tue_sat") == ["Tue", "Wed", "Thu", "Fri", "Sat"]
    assert kept("mon_fri") == ["Mon", "Tue", "Wed", "Thu", "Fri"]


def test_texts(spark):
    row = spark.range(1).select(
        bands.drift_text(F.lit(0.0312)).alias("a"), bands.drift_text(F.lit(-0.05)).alias("b"), bands.auc_text(F.lit(None).cast("double")).alias("c"),
        bands.auc_text(F.lit(0.97321)).alias("d"), bands.percent_text(F.lit(0.455)).alias("e"), bands.busyness_level(F.lit(0.6)).alias("f"),
        bands.busyness_label(F.lit(None).cast("double")).alias("g"), hour_label(F.lit(0)).alias("h"), hour_label(F.lit(12)).alias("i"),
        hour_label(F.lit(17)).alias("j"), bands.rate_position(F.lit(0.5)).alias("k"), bands.congestion_band(F.lit(0.7)).alias("l"),
    ).first()
    assert tuple(row) == ("+3.1%", "-5.0%", "N/A", "0.9732", "46%", "high", "No data", "12:00 AM", "12:00 PM", "5:00 PM", 1.0, 2)


@pytest.fixture
def small_forecast(spark):
    lookup = spark.createDataFrame(
        [("A", d, h, float(d * 100 + h)) for d in range(7) for h in range(24) if (d, h) != (3, 5)],
        "station_complex string, dow int, hour int, avg_ridership double",
    )
    table = frame(spark, ["A", "Z"]).select("station_complex", *[F.lit(1).alias(c) for c in STATION_FEATURES])
    return table, lookup


def test_forecast_features_look_up_the_weekly_profile(spark, small_forecast):
    df = forecast.forecast_features(*small_forecast, "2024-11-04", 10)  # a Monday
    assert df.columns[2:] == FEATURE_COLS and df.count() == 2 * 10 * 24
    at = lambda t, s="A": df.where((F.col("transit_timestamp") == t) & (F.col("station_complex") == s)).first()
    monday = at("2024-11-04 00:00:00")
    assert (monday.lag_1, monday.lag_24, monday.lag_168) == (123.0, 0.0, 100.0)  # hour 23 of the same weekday
    assert monday.roll_mean_24 == pytest.approx(100 + 11.5)
    assert at("2024-11-06 06:00:00").lag_1 == 0.0  # missing cell
    assert at("2024-11-11 09:00:00").is_holiday == 1 and at("2024-11-10 09:00:00").is_holiday_eve == 1
    z = at("2024-11-04 08:00:00", "Z")
    assert (z.lag_1, z.lag_24, z.lag_168, z.roll_mean_24, z.roll_mean_168, z.roll_std_24) == (0.0,) * 6


def test_run_forecast_keeps_known_stations_under_one_name(spark, small_forecast):
    table, lookup = small_forecast
    limits = frame(spark, [("A", 1.0)], "station_complex string, threshold double")
    scorer = lambda df: df.withColumn("predicted_prob", F.lit(0.12345))
    got = forecast.run_forecast(table, lookup, limits, scorer, "2024-11-04", 2)
    assert got.count() == 48 and {r.station for r in got.collect()} == {"A"} and got.first().prob == 0.123
    nested = forecast.nest_forecast(got).first()
    assert set(nested.dates) == {"2024-11-04", "2024-11-05"} and len(nested.dates["2024-11-04"]) == 24
    week = forecast.next_days(got, "A", 8, "2024-11-04", 3).collect()
    assert [r.label for r in week] == ["Quieter than usual", "Quieter than usual", "No data"]


def test_quietest_hour(spark):
    rows = [("A", dt.date(2024, 1, 1), h, p) for h, p in enumerate([0.5, 0.2, 0.2, 0.9, 0.1, 0.3])]
    df = spark.createDataFrame(rows, "station string, date date, hour int, prob double")
    assert [r.best_hour for r in forecast.quietest_hour(df).orderBy("hour").collect()] == [1, 1, 4, 4, 4, 4]
    flat = df.withColumn("prob", F.lit(0.4))
    assert [r.best_hour for r in forecast.quietest_hour(flat).orderBy("hour").collect()] == list(range(6))


def test_lookup_export_and_reload(spark, small_forecast, tmp_path):
    _, lookup = small_forecast
    write_json(lookups.nest_lookup(lookup), f"{tmp_path}/lookup")
    exported = spark.read.schema("station_complex string, dows map<string,map<string,double>>").json(f"{tmp_path}/lookup")
    back = lookups.unnest_lookup(exported)
    assert back.exceptAll(lookup).count() == 0 and lookup.exceptAll(back).count() == 0


def test_station_averages_use_the_population_deviation(spark):
    lookup = spark.createDataFrame([("A", 0, 0, 2.0), ("A", 0, 1, 4.0)], "station_complex string, dow int, hour int, avg_ridership double")
    row = lookups.station_averages(lookup).first()
    assert (row.overall_mean, row.overall_std) == (3.0, 1.0)


def test_map_defaults(spark, hours):
    fact = hours([("A", "2023-05-01T00:00:00", 1.0), ("B", "2023-05-01T00:00:00", 1.0)]).withColumns(
        {"latitude": F.when(F.col("station_complex") == "A", 40.123456), "longitude": F.lit(-73.9)}
    )
    scored = spark.createDataFrame(
        [("A", 1, 0.5, 2, 3), ("B", 0, 0.1, 1, 1)], "station_complex string, actual int, predicted_prob double, num_lines int, station_tier int"
    ).withColumn("is_congested", F.col("actual"))
    table = frame(spark, ["A"]).select("station_complex", *[F.lit(0).alias(c) for c in BOROUGH_FLAGS])
    got = exports.station_map(fact, scored.where("station_complex = 'B'"), scored, table).collect()
    assert [(r.name, r.lat, r.drift, r.auc, r.borough) for r in got] == [("A", 40.12346, 0.0, None, "Unknown")]
    details = exports.map_details(exports.station_map(fact, scored, scored, table)).first()
    assert details.auc_text == "N/A" and details.radius == 8.5


def test_exports_are_json_lines(spark, small_forecast, hours, tmp_path):
    table, lookup = small_forecast
    limits = frame(spark, [("A", 1.0)], "station_complex string, threshold double")
    scorer = lambda df: df.withColumn("predicted_prob", F.lit(0.5))
    df = forecast.run_forecast(table, lookup, limits, scorer, "2024-11-04", 2)
    forecast.export_forecast(df, table, f"{tmp_path}/forecast", "2024-11-03 06:00")
    info = spark.read.json(f"{tmp_path}/forecast/info").first()
    assert (info.days_ahead, info.start_date, info.end_date, info.stations) == (2, "2024-11-04", "2024-11-05", 1)
    assert spark.read.json(f"{tmp_path}/forecast/meta").first().borough == "Manhattan"

    fact = hours([("A (1,2)", "2025-10-07T08:00:00", 10.0), ("A (1,2)", "2025-10-07T08:00:00", 30.0)])
    fact = fact.withColumns({"latitude": F.lit(40.0), "longitude": F.lit(-73.0)})
    stations_table = frame(spark, ["A (1,2)"]).select("station_complex", *[F.lit(1).alias(c) for c in STATION_FEATURES])
    exports.export_animation(fact, stations_table, f"{tmp_path}/animation")
    daily = spark.read.json(f"{tmp_path}/animation/daily").first()
    assert (daily.hours["8"].r, daily.hours["8"].n) == (20.0, 1.0)  # per record
    week = spark.read.json(f"{tmp_path}/animation/week").first()
    assert (week.r, week.n) == (40.0, 1.0)  # per hour, at most 1
    assert sorted(r.line for r in spark.read.json(f"{tmp_path}/animation/all_lines").collect()) == ["1", "2"]


def test_results_come_in_their_order(spark):
    rows = [(f"2024-01-{d:02d}T{h:02d}:00:00", s, float(h), 40.0, -73.0) for s in "BA" for d in (9, 8) for h in (5, 3)]
    df = spark.createDataFrame(rows, "t string, station_complex string, ridership double, latitude double, longitude double").selectExpr(
        "cast(t as timestamp_ntz) as transit_timestamp", "* except (t)")
    day = [(r.station_complex, r.hour) for r in rollups.average_day(df, 2024).collect()]
    week = [(r.transit_timestamp, r.station_complex) for r in rollups.week_slice(df, "2024-01-08", "2024-01-15").collect()]
    lookup = [(r.station_complex, r.dow, r.hour) for r in lookups.lag_lookup(df, 2024).collect()]
    for got, n in ((day, 4), (week, 8), (lookup, 8)):
        assert got == sorted(got) and len(got) == n


def test_normalised_rows(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("A", None), ("B", 2.0), (None, 5.0), (None, 9.0)], "station_complex string, ridership double")
    got = {(r.station_complex, r.ridership): r.ridership_norm for r in evaluate.normalise_ridership(df).collect()}
    assert got[("A", 3.0)] == pytest.approx(1, abs=1e-6) and got[("A", 1.0)] == got[("B", 2.0)] == got[(None, 5.0)] == 0
    assert got[("A", None)] is None and got[(None, 9.0)] == pytest.approx(1, abs=1e-6)
