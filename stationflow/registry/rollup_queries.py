"""Registered queries: scans, filters, rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import rollups
from stationflow.registry.adapters import D, H, HH, hourly_events, hourly_sql, orders_view
from stationflow.registry.base import query, rounded
from stationflow.session import materialise
from stationflow.sources.facts import distinct_months, in_years, only_stations, partition_keys

RANGE = dict(start="2024-01-05", end="2024-01-20")


@query("hourly_rollup", f"WITH {HH} SELECT * FROM hh")
def hourly_rollup(spark, sf_dir):
    return rollups.hourly_ridership(hourly_events(spark, sf_dir))


@query(
    "hourly_rollup_filtered",
    f"""WITH {H}, {hourly_sql("h", "hh", "station_complex = 'Pelham Bay Park (6)' AND transit_timestamp >= '2024-01-05' AND transit_timestamp < '2024-01-20'")}
    SELECT * FROM hh ORDER BY transit_timestamp""",
)
def hourly_rollup_filtered(spark, sf_dir):
    df = rollups.hourly_ridership(hourly_events(spark, sf_dir), "Pelham Bay Park (6)", **RANGE)
    return df.orderBy("transit_timestamp")


@query(
    "busiest_stations",
    f"""WITH {D} SELECT station_complex, borough, CAST(SUM(ridership) AS DOUBLE) AS total_ridership
    FROM d GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
)
def busiest_stations(spark, sf_dir):
    return rollups.busiest_stations(orders_view(spark, sf_dir), limit=10)


@query(
    "by_hour",
    f"""WITH {H} SELECT CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
    round(AVG(CAST(ridership AS DOUBLE)), 6) AS avg_ridership, CAST(SUM(ridership) AS DOUBLE) AS total_ridership
    FROM h GROUP BY 1""",
)
def by_hour(spark, sf_dir):
    return rounded(rollups.ridership_by_hour(hourly_events(spark, sf_dir)), ["avg_ridership"])


@query(
    "by_borough",
    f"""WITH {D} SELECT borough, CAST(SUM(ridership) AS DOUBLE) AS total_ridership, COUNT(*) AS records
    FROM d GROUP BY 1""",
)
def by_borough(spark, sf_dir):
    return rollups.ridership_by_borough(orders_view(spark, sf_dir))


@query(
    "by_dow_hour",
    f"""WITH {H} SELECT CAST(dayofweek(transit_timestamp) AS INTEGER) AS day_of_week, dayname(transit_timestamp) AS day_name,
    CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day, round(AVG(CAST(ridership AS DOUBLE)), 6) AS avg_ridership
    FROM h GROUP BY 1, 2, 3""",
)
def by_dow_hour(spark, sf_dir):
    return rounded(rollups.ridership_by_day_of_week(hourly_events(spark, sf_dir)), ["avg_ridership"])


@query(
    "dataset_summary",
    f"""WITH {HH} SELECT COUNT(*) AS rows, COUNT(DISTINCT station_complex) AS stations,
    MIN(transit_timestamp) AS first_ts, MAX(transit_timestamp) AS last_ts FROM hh""",
)
def dataset_summary(spark, sf_dir):
    return rollups.dataset_summary(hourly_rollup(spark, sf_dir))


@query(
    "weekday_boxplot",
    f"""WITH {HH} SELECT CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week,
    round(MIN(ridership), 6) AS min, round(quantile_cont(ridership, 0.25), 6) AS q1,
    round(quantile_cont(ridership, 0.5), 6) AS median, round(quantile_cont(ridership, 0.75), 6) AS q3,
    round(MAX(ridership), 6) AS max FROM hh GROUP BY 1""",
)
def weekday_boxplot(spark, sf_dir):
    return rounded(rollups.weekday_spread(materialise(hourly_rollup(spark, sf_dir), "hourly")), ["min", "q1", "median", "q3", "max"])


@query(
    "ridership_heatmap",
    f"""WITH {HH} SELECT CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week, """
    + ", ".join(f"round(AVG(ridership) FILTER (hour(transit_timestamp) = {h}), 6) AS h{h:02d}" for h in range(24))
    + " FROM hh GROUP BY 1",
)
def ridership_heatmap(spark, sf_dir):
    grid = rollups.hour_weekday_matrix(hourly_rollup(spark, sf_dir), "ridership")
    return rounded(grid, [f"h{h:02d}" for h in range(24)])


PROFILE = """profile AS (SELECT station_complex, station_complex_id, borough, AVG(r) AS avg_ridership,
  stddev_samp(r) AS std_ridership, MAX(r) AS max_ridership,
  COUNT(DISTINCT date_trunc('month', transit_timestamp)) AS months_of_data
  FROM (SELECT station_complex, station_complex_id, borough, transit_timestamp, CAST(SUM(ridership) AS DOUBLE) AS r
    FROM {source} WHERE year(transit_timestamp) IN ({years}) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)"""


@query(
    "station_profile",
    f"""WITH {D}, {PROFILE.format(source="d", years="1999, 2000")}
    SELECT station_complex, station_complex_id, borough, round(avg_ridership, 6) AS avg_ridership,
    round(std_ridership, 6) AS std_ridership, max_ridership, months_of_data FROM profile""",
)
def station_profile(spark, sf_dir):
    df = rollups.station_profile(orders_view(spark, sf_dir), (1999, 2000))
    return rounded(df, ["avg_ridership", "std_ridership"])


@query(
    "station_coords",
    f"""WITH {H} SELECT station_complex, round(AVG(latitude), 6) AS lat, round(AVG(longitude), 6) AS lon
    FROM h WHERE year(transit_timestamp) IN (2023, 2024) AND latitude IS NOT NULL GROUP BY 1""",
)
def station_coords(spark, sf_dir):
    return rounded(rollups.station_coordinates(hourly_events(spark, sf_dir)), ["lat", "lon"])


AVERAGE_DAY = """cells AS (SELECT station_complex, CAST(hour(transit_timestamp) AS INTEGER) AS hour,
  AVG(CAST(ridership AS DOUBLE)) AS avg_ridership, AVG(latitude) AS lat, AVG(longitude) AS lon FROM h
  WHERE year(transit_timestamp) = 2024 AND dayofweek(transit_timestamp) BETWEEN {first} AND {last}
  AND latitude IS NOT NULL GROUP BY 1, 2)"""
DAY = AVERAGE_DAY.format(first=2, last=6)


@query(
    "average_day",
    f"""WITH {H}, {DAY} SELECT station_complex, hour, round(avg_ridership, 6) AS avg_ridership,
    round(lat, 6) AS lat, round(lon, 6) AS lon FROM cells""",
)
def average_day(spark, sf_dir):
    return rounded(rollups.average_day(hourly_events(spark, sf_dir), 2024), ["avg_ridership", "lat", "lon"])


@query(
    "average_day_mon_fri",
    f"""WITH {H}, {AVERAGE_DAY.format(first=1, last=5)} SELECT station_complex, hour,
    round(avg_ridership, 6) AS avg_ridership, round(lat, 6) AS lat, round(lon, 6) AS lon FROM cells""",
)
def average_day_mon_fri(spark, sf_dir):
    df = rollups.average_day(hourly_events(spark, sf_dir), 2024, weekdays="mon_fri")
    return rounded(df, ["avg_ridership", "lat", "lon"])


@query(
    "week_slice",
    f"""WITH {H} SELECT station_complex, transit_timestamp, CAST(SUM(ridership) AS DOUBLE) AS ridership,
    round(AVG(latitude), 6) AS lat, round(AVG(longitude), 6) AS lon FROM h
    WHERE transit_timestamp >= '2024-01-08' AND transit_timestamp < '2024-01-15' AND latitude IS NOT NULL GROUP BY 1, 2""",
)
def week_slice(spark, sf_dir):
    return rounded(rollups.week_slice(hourly_events(spark, sf_dir), "2024-01-08", "2024-01-15"), ["lat", "lon"])


@query("p95_ceiling", f"WITH {H}, {DAY} SELECT round(quantile_cont(avg_ridership, 0.95), 6) AS ceiling FROM cells")
def p95_ceiling(spark, sf_dir):
    return rounded(rollups.normaliser(rollups.average_day(hourly_events(spark, sf_dir), 2024)), ["ceiling"])


@query(
    "densify_hours",
    f"""WITH {HH}, span AS (SELECT station_complex, MIN(transit_timestamp) AS a, MAX(transit_timestamp) AS b FROM hh GROUP BY 1),
    spine AS (SELECT station_complex, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS transit_timestamp FROM span)
    SELECT spine.station_complex, spine.transit_timestamp, ridership FROM spine LEFT JOIN hh
    ON spine.station_complex = hh.station_complex AND spine.transit_timestamp = hh.transit_timestamp""",
)
def densify_hours(spark, sf_dir):
    return rollups.densify_hours(hourly_rollup(spark, sf_dir))


@query(
    "year_filter",
    f"""WITH {D} SELECT station_complex, COUNT(*) AS n, CAST(SUM(ridership) AS DOUBLE) AS ridership
    FROM d WHERE year(transit_timestamp) IN (1999, 2000) GROUP BY 1""",
)
def year_filter(spark, sf_dir):
    kept = in_years(orders_view(spark, sf_dir), 1999, 2000)
    return kept.groupBy("station_complex").agg(F.count("*").alias("n"), F.sum("ridership").cast("double").alias("ridership"))


@query(
    "partition_keys",
    f"WITH {D} SELECT DISTINCT CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month FROM d",
)
def partition_key_list(spark, sf_dir):
    return distinct_months(partition_keys(orders_view(spark, sf_dir)))


@query(
    "station_sample",
    f"""WITH {HH} SELECT * FROM hh WHERE station_complex IN ('Plain Plaza', 'Pelham Bay Park (6)')""",
)
def station_sample(spark, sf_dir):
    return only_stations(hourly_rollup(spark, sf_dir), ["Plain Plaza", "Pelham Bay Park (6)"])
