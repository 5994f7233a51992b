"""Registered queries: lookups, forecasts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions import bands
from stationflow.functions.timeparts import hour_label
from stationflow.operators import lookups
from stationflow.operators.labels import congestion_thresholds
from stationflow.operators.stations import merge_station_features
from stationflow.plans import artefacts, exports, forecast
from stationflow.registry.adapters import H, HH, hourly_events
from stationflow.registry.base import query, rounded, rounds
from stationflow.registry.evaluation_queries import S, auc_sql, scored_events
from stationflow.registry.feature_queries import (
    MEANS, STATIONS, WAVES, calendar_sql, event_stations, events_hourly, events_table, holiday_sql, time_sql,
)
from stationflow.registry.rollup_queries import DAY
from stationflow.schema import STATION_FEATURES
from stationflow.session import materialise, scratch_path

START, DAYS = "2024-02-10", 21

LOOKUP = """hy AS (SELECT transit_timestamp, station_complex, CAST(SUM(ridership) AS DOUBLE) AS r FROM h
    WHERE year(transit_timestamp) = 2024 AND latitude IS NOT NULL GROUP BY 1, 2),
  look AS (SELECT station_complex, CAST(dayofweek(transit_timestamp) AS INTEGER) AS dow, CAST(hour(transit_timestamp) AS INTEGER) AS hour,
    AVG(r) AS avg_ridership FROM hy GROUP BY 1, 2, 3),
  dm AS (SELECT station_complex, dow, AVG(avg_ridership) AS dow_mean FROM look GROUP BY 1, 2),
  om AS (SELECT station_complex, AVG(avg_ridership) AS overall_mean, stddev_pop(avg_ridership) AS overall_std FROM look GROUP BY 1)"""


def event_lookup(spark, sf_dir):
    return lookups.lag_lookup(hourly_events(spark, sf_dir), 2024)


@query("lag_lookup", f"WITH {H}, {LOOKUP} SELECT * REPLACE ({rounds(['avg_ridership'])}) FROM look")
def lag_lookup(spark, sf_dir):
    return rounded(event_lookup(spark, sf_dir), ["avg_ridership"])


@query(
    "lag_lookup_reloaded",
    f"WITH {H}, {LOOKUP} SELECT * REPLACE (round_even(avg_ridership, 5) AS avg_ridership) FROM look",
)
def lag_lookup_reloaded(spark, sf_dir):
    # five digits: means of few cents often lie halfway between two of two digits
    return lookups.unnest_lookup(lookups.nest_lookup(event_lookup(spark, sf_dir), digits=5))


@query(
    "station_averages",
    f"WITH {H}, {LOOKUP} SELECT station_complex, {rounds(['overall_mean', 'overall_std'])} FROM om",
)
def station_averages(spark, sf_dir):
    return rounded(lookups.station_averages(event_lookup(spark, sf_dir)), ["overall_mean", "overall_std"])


@query("weekday_means", f"WITH {H}, {LOOKUP} SELECT * REPLACE ({rounds(['dow_mean'])}) FROM dm")
def weekday_means(spark, sf_dir):
    return rounded(lookups.weekday_means(event_lookup(spark, sf_dir)), ["dow_mean"])


FUTURE = f"""{H}, {STATIONS}, {LOOKUP}, {calendar_sql(2023, 2025)},
  spine AS (SELECT st.*, t.x AS transit_timestamp, CAST(dayofweek(t.x) AS INTEGER) AS dw, CAST(hour(t.x) AS INTEGER) AS hr
    FROM st CROSS JOIN generate_series(TIMESTAMP '{START}', TIMESTAMP '{START}' + INTERVAL {DAYS * 24 - 1} HOUR, INTERVAL 1 HOUR) t(x)),
  raw AS (SELECT spine.*, coalesce(a.avg_ridership, 0) AS lag_1, coalesce(b.avg_ridership, 0) AS lag_24, coalesce(c.avg_ridership, 0) AS lag_168,
    coalesce(dow_mean, 0) AS roll_mean_24, coalesce(overall_mean, 0) AS roll_mean_168, coalesce(overall_std, 0) AS roll_std_24 FROM spine
    LEFT JOIN look a ON a.station_complex = spine.station_complex AND a.dow = dw AND a.hour = (hr + 23) % 24
    LEFT JOIN look b ON b.station_complex = spine.station_complex AND b.dow = (dw + 6) % 7 AND b.hour = hr
    LEFT JOIN look c ON c.station_complex = spine.station_complex AND c.dow = dw AND c.hour = hr
    LEFT JOIN dm ON dm.station_complex = spine.station_complex AND dm.dow = dw
    LEFT JOIN om ON om.station_complex = spine.station_complex)"""
LAGS = ["lag_1", "lag_24", "lag_168", "roll_mean_24", "roll_mean_168", "roll_std_24"]


@query(
    "forecast_features",
    f"""WITH {FUTURE} SELECT station_complex, transit_timestamp, {time_sql()}, {rounds(LAGS)}, {holiday_sql()},
    {", ".join(f"round({c}, 6) AS {c}" if c in MEANS else c for c in STATION_FEATURES)} FROM raw""",
)
def forecast_features(spark, sf_dir):
    df = forecast.forecast_features(event_stations(spark, sf_dir), event_lookup(spark, sf_dir), START, DAYS)
    return rounded(df, [*LAGS, *WAVES, *MEANS])


def event_forecast(spark, sf_dir):
    scorer = lambda df: df.withColumn("predicted_prob", F.col("lag_168") / (F.col("lag_168") + 50.0))
    limits = congestion_thresholds(events_table(spark, sf_dir))
    return forecast.run_forecast(event_stations(spark, sf_dir), event_lookup(spark, sf_dir), limits, scorer, START, DAYS)


FORECAST = f"""{FUTURE}, fc AS (SELECT station_complex AS station, CAST(transit_timestamp AS DATE) AS date, hr AS hour,
  round_even(lag_168 / (lag_168 + 50), 3) AS prob FROM raw)"""


@query("run_forecast", f"WITH {FORECAST} SELECT * FROM fc")
def run_forecast(spark, sf_dir):
    return event_forecast(spark, sf_dir)


@query("forecast_from_store", f"WITH {FORECAST} SELECT *, 'second' AS version FROM fc")
def forecast_from_store(spark, sf_dir):
    """Thresholds, station features and lookup published twice, with other values first; a forecast from the last version."""
    root = scratch_path(spark, "artefacts")
    tables = {"thresholds": congestion_thresholds(events_table(spark, sf_dir)), "stations": event_stations(spark, sf_dir), "lookup": event_lookup(spark, sf_dir)}
    tables = {name: materialise(df, name) for name, df in tables.items()}
    other = tables["lookup"].withColumn("avg_ridership", F.col("avg_ridership") * 2)
    artefacts.publish(spark, root, "first", {**tables, "lookup": other})
    artefacts.publish(spark, root, "second", tables)
    found = artefacts.load(spark, root)
    scorer = lambda df: df.withColumn("predicted_prob", F.col("lag_168") / (F.col("lag_168") + 50.0))
    return artefacts.forecast_from(found, START, DAYS, scorer).withColumn("version", F.lit(found.version))


@query("forecast_meta", f"WITH {FORECAST} SELECT DISTINCT station, borough, station_tier AS tier FROM fc JOIN st ON station = station_complex")
def forecast_meta(spark, sf_dir):
    return forecast.forecast_meta(event_stations(spark, sf_dir), event_forecast(spark, sf_dir))


@query(
    "forecast_info",
    f"""WITH {FORECAST} SELECT CAST('2024-02-09 06:00' AS VARCHAR) AS generated_at, COUNT(DISTINCT date) AS days_ahead,
    MIN(date) AS start_date, MAX(date) AS end_date, COUNT(DISTINCT station) AS stations FROM fc""",
)
def forecast_info(spark, sf_dir):
    return forecast.forecast_info(event_forecast(spark, sf_dir), "2024-02-09 06:00")


@query(
    "forecast_nested",
    f"WITH {FORECAST} SELECT station, COUNT(DISTINCT date) AS days, COUNT(*) AS hours, round(SUM(prob), 3) AS total FROM fc GROUP BY 1",
)
def forecast_nested(spark, sf_dir):
    """The nested export read back and counted."""
    nested = forecast.nest_forecast(event_forecast(spark, sf_dir))
    dates = nested.select("station", F.explode("dates").alias("date", "hours"))
    cells = dates.select("station", "date", F.explode("hours").alias("hour", "prob"))
    counted = cells.groupBy("station").agg(
        F.countDistinct("date").alias("days"), F.count("*").alias("hours"), F.sum("prob").alias("total")
    )
    return rounded(counted, ["total"], 3)


@query(
    "quietest_hour",
    f"""WITH {FORECAST}, o AS (SELECT a.station, a.date, a.hour, a.prob, b.hour AS best_hour, b.prob AS best_prob,
      row_number() OVER (PARTITION BY a.station, a.date, a.hour ORDER BY b.prob, b.hour <> a.hour, b.hour) AS rn
      FROM fc a JOIN fc b ON a.station = b.station AND a.date = b.date AND b.hour BETWEEN a.hour - 2 AND a.hour + 2)
    SELECT * EXCLUDE (rn) FROM o WHERE rn = 1""",
)
def quietest_hour(spark, sf_dir):
    return forecast.quietest_hour(event_forecast(spark, sf_dir))


BUSY = """CASE WHEN prob IS NULL THEN 'na' WHEN prob >= 0.6 THEN 'high' WHEN prob >= 0.3 THEN 'moderate' ELSE 'low' END AS level,
  CASE WHEN prob IS NULL THEN 'No data' WHEN prob >= 0.6 THEN 'Busier than usual' WHEN prob >= 0.3 THEN 'Moderately busy'
    ELSE 'Quieter than usual' END AS label,
  CASE WHEN prob IS NULL THEN '' ELSE CAST(CAST(floor(prob * 100 + 0.5) AS INTEGER) AS VARCHAR) || '%' END AS percent"""


@query("busyness_band", f"WITH {FORECAST} SELECT *, {BUSY} FROM fc")
def busyness_band(spark, sf_dir):
    return forecast.with_busyness(event_forecast(spark, sf_dir))


@query(
    "next_14_days",
    f"""WITH {FORECAST}, days AS (SELECT CAST(x AS DATE) AS date FROM generate_series(TIMESTAMP '2024-02-24', TIMESTAMP '2024-03-08', INTERVAL 1 DAY) t(x)),
    j AS (SELECT days.date, prob FROM days LEFT JOIN fc ON fc.date = days.date AND station = 'Plain Plaza' AND hour = 17) SELECT *, {BUSY} FROM j""",
)
def next_14_days(spark, sf_dir):
    return forecast.next_days(event_forecast(spark, sf_dir), "Plain Plaza", 17, "2024-02-24")


@query(
    "hour_labels",
    f"""WITH {HH} SELECT CAST(hour(transit_timestamp) AS INTEGER) AS hour, COUNT(*) AS n,
    ltrim(strftime(CAST('2000-01-01' AS TIMESTAMP) + to_hours(hour(transit_timestamp)), '%I:00 %p'), '0') AS hour_label FROM hh GROUP BY ALL""",
)
def hour_labels(spark, sf_dir):
    counted = events_hourly(spark, sf_dir).groupBy(F.hour("transit_timestamp").alias("hour")).agg(F.count("*").alias("n"))
    return counted.withColumn("hour_label", hour_label(F.col("hour")))


# --- exports --------------------------------------------------------------------------------
TRAIN = "transit_timestamp < '2024-01-16'"
MAP = f"""WITH {S}, {STATIONS}, r1 AS (SELECT station_complex, AVG(is_congested) AS train_rate FROM s WHERE {TRAIN} GROUP BY 1),
  r2 AS (SELECT station_complex, AVG(actual) AS rate FROM s GROUP BY 1), a AS (WITH {auc_sql('s', 'station_complex')}),
  xy AS (SELECT station_complex, AVG(latitude) AS lat, AVG(longitude) AS lon FROM h GROUP BY 1),
  m AS (SELECT station_complex AS name, round_even(lat, 5) AS lat, round_even(lon, 5) AS lon, round_even(rate, 4) AS congestion_rate,
    round_even(coalesce(rate - train_rate, 0), 4) AS drift, round_even(auc, 4) AS auc, num_lines, station_tier, borough
    FROM r2 JOIN xy USING (station_complex) LEFT JOIN r1 USING (station_complex) LEFT JOIN a USING (station_complex)
    JOIN st USING (station_complex))"""


def event_map(spark, sf_dir):
    stations = event_stations(spark, sf_dir)
    scored = materialise(merge_station_features(scored_events(spark, sf_dir), stations), "scored")
    train = scored.where(F.col("transit_timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return exports.station_map(hourly_events(spark, sf_dir), train, scored, stations)


@query("map_export", f"{MAP} SELECT * FROM m")
def map_export(spark, sf_dir):
    return event_map(spark, sf_dir)


@query("map_written", f"{MAP} SELECT * FROM m")
def map_written(spark, sf_dir):
    """The exported map read back."""
    path, records = scratch_path(spark, "map"), event_map(spark, sf_dir)
    exports.export_map(records, path)
    return spark.read.schema(records.schema).json(path)


PERCENT = "concat(CAST(CAST(CAST({x} * 100 AS DECIMAL(18, 6)) AS DECIMAL(18, 1)) AS VARCHAR), '%')"
CLAMP = "round(least(1.0, greatest(0.0, {x})), 6)"


@query(
    "map_details",
    f"""{MAP} SELECT m.*, {CLAMP.format(x='(congestion_rate - 0.10) / 0.32')} AS rate_position, {CLAMP.format(x='(drift + 0.10) / 0.22')} AS drift_position,
    {CLAMP.format(x='1 - (auc - 0.92) / 0.07')} AS auc_position, CAST(4 + station_tier * 1.5 AS DOUBLE) AS radius,
    {PERCENT.format(x='congestion_rate')} AS rate_text,
    concat(CASE WHEN drift >= 0 THEN '+' ELSE '' END, {PERCENT.format(x='drift')}) AS drift_text,
    CASE WHEN coalesce(auc, 0) = 0 THEN 'N/A' ELSE format('{{:.4f}}', auc) END AS auc_text FROM m""",
)
def map_details(spark, sf_dir):
    return rounded(exports.map_details(event_map(spark, sf_dir)), ["rate_position", "drift_position", "auc_position"])


CEILING = f"{H}, {DAY}, ceil AS (SELECT quantile_cont(avg_ridership, 0.95) AS c FROM cells)"


@query(
    "animation_daily",
    f"""WITH {CEILING} SELECT station_complex, hour, round_even(lat, 5) AS lat, round_even(lon, 5) AS lon,
    round_even(avg_ridership, 1) AS r, round_even(CASE WHEN c > 0 THEN avg_ridership / c ELSE 0 END, 4) AS n FROM cells, ceil""",
)
def animation_daily(spark, sf_dir):
    return exports.animation_daily(hourly_events(spark, sf_dir), 2024)


@query(
    "animation_written",
    f"""WITH {CEILING} SELECT station_complex, CAST(hour AS VARCHAR) AS hour, round_even(lat, 5) AS lat, round_even(lon, 5) AS lon,
    round_even(avg_ridership, 1) AS r, round_even(CASE WHEN c > 0 THEN avg_ridership / c ELSE 0 END, 4) AS n FROM cells, ceil""",
)
def animation_written(spark, sf_dir):
    """The nested average day of the exported animation, read back."""
    path = scratch_path(spark, "animation")
    exports.export_animation(hourly_events(spark, sf_dir), event_stations(spark, sf_dir), path, year=2024, start="2024-01-08", end="2024-01-15")
    daily = spark.read.schema("station_complex string, lat double, lon double, hours map<string, struct<r: double, n: double>>").json(f"{path}/daily")
    return daily.select("station_complex", "lat", "lon", F.explode("hours").alias("hour", "cell")).select("station_complex", "hour", "lat", "lon", "cell.r", "cell.n")


@query(
    "animation_week",
    f"""WITH {CEILING}, w AS (SELECT transit_timestamp, station_complex, CAST(SUM(ridership) AS DOUBLE) AS x FROM h
      WHERE transit_timestamp >= '2024-01-08' AND transit_timestamp < '2024-01-15' AND latitude IS NOT NULL GROUP BY 1, 2)
    SELECT transit_timestamp, station_complex, round_even(x, 1) AS r, round_even(least(1.0, CASE WHEN c > 0 THEN x / c ELSE 0 END), 4) AS n FROM w, ceil""",
)
def animation_week(spark, sf_dir):
    return exports.animation_week(hourly_events(spark, sf_dir), 2024, "2024-01-08", "2024-01-15")


@query(
    "congestion_bands",
    f"""WITH {CEILING}, x AS (SELECT station_complex, hour, round_even(CASE WHEN c > 0 THEN avg_ridership / c ELSE 0 END, 4) AS n FROM cells, ceil)
    SELECT *, CASE WHEN n > 0.7 THEN 3 WHEN n > 0.4 THEN 2 WHEN n > 0.2 THEN 1 ELSE 0 END AS band FROM x""",
)
def congestion_bands(spark, sf_dir):
    cells = exports.animation_daily(hourly_events(spark, sf_dir), 2024).select("station_complex", "hour", "n")
    return cells.withColumn("band", bands.congestion_band(F.col("n")))


@query(
    "auc_bands",
    f"""WITH {S}, a AS (WITH {auc_sql('s', 'station_complex')})
    SELECT station_complex, auc, CASE WHEN auc >= 0.97 THEN 'high' WHEN auc >= 0.95 THEN 'medium' ELSE 'low' END AS band FROM a""",
)
def auc_bands(spark, sf_dir):
    from stationflow.operators.evaluate import roc_auc

    scored = roc_auc(scored_events(spark, sf_dir), ["station_complex"]).select("station_complex", "auc")
    return rounded(scored.withColumn("band", bands.auc_band(F.col("auc"))), ["auc"])
