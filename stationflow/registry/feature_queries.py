"""Registered queries: features, labels, stations."""

from __future__ import annotations


from pyspark.sql import functions as F

from stationflow.functions import names
from stationflow.functions.holidays import holiday_calendar
from stationflow.operators import features, labels, stations
from stationflow.operators.quantiles import exact_quantiles
from stationflow.operators.rollups import hourly_ridership
from stationflow.plans.training import build_features
from stationflow.registry.adapters import D, DD, H, HH, P, hourly_events, orders_view, part_names
from stationflow.registry.base import query, rounded, rounds
from stationflow.registry.rollup_queries import PROFILE
from stationflow.session import materialise
from stationflow.schema import BOROUGH_FLAGS, BOROUGHS, LAG_FEATURES, STATION_FEATURES, TERMINAL_STATIONS, WEEKDAY_FLAGS


def events_hourly(spark, sf_dir):
    return hourly_ridership(hourly_events(spark, sf_dir))


def orders_hourly(spark, sf_dir):
    return hourly_ridership(orders_view(spark, sf_dir))


def events_table(spark, sf_dir):
    """The hourly series as a written table, for work that reads it several times."""
    return materialise(events_hourly(spark, sf_dir), "hourly")


def orders_table(spark, sf_dir):
    return materialise(orders_hourly(spark, sf_dir), "hourly")


# --- time ------------------------------------------------------------------------------
def time_sql(ts: str = "transit_timestamp") -> str:
    hour, month, dow = f"hour({ts})", f"month({ts})", f"isodow({ts})"
    flags = ", ".join(f"CAST({dow} = {i + 1} AS INTEGER) AS {flag}" for i, flag in enumerate(WEEKDAY_FLAGS))
    wave = lambda f, x, n: f"round({f}(2 * pi() * {x} / {n}), 6)"
    return f"""CAST({hour} AS INTEGER) AS hour, CAST({dow} - 1 AS INTEGER) AS day_of_week, CAST({month} AS INTEGER) AS month,
      CAST(week({ts}) AS INTEGER) AS week_of_year, CAST({dow} IN (6, 7) AS INTEGER) AS is_weekend,
      CAST({dow} IN (1, 5) AS INTEGER) AS is_shoulder_day, {flags},
      {wave("sin", hour, 24)} AS hour_sin, {wave("cos", hour, 24)} AS hour_cos,
      {wave("sin", month, 12)} AS month_sin, {wave("cos", month, 12)} AS month_cos"""


WAVES = ["hour_sin", "hour_cos", "month_sin", "month_cos"]


@query("time_features", f"WITH {DD} SELECT transit_timestamp, station_complex, ridership, {time_sql()} FROM dd")
def time_features(spark, sf_dir):
    return rounded(features.add_time_features(orders_hourly(spark, sf_dir)), WAVES)


# --- holidays: an independent rule in SQL -----------------------------------------------
def calendar_sql(first: int, last: int) -> str:
    return f"""cal AS (SELECT CAST(x AS DATE) AS d, year(x) AS y, month(x) AS m, day(x) AS dd, isodow(x) AS w
      FROM generate_series(TIMESTAMP '{first}-01-01', TIMESTAMP '{last}-12-31', INTERVAL 1 DAY) t(x)),
    fixed AS (SELECT d, w FROM cal WHERE (m = 1 AND dd = 1) OR (m = 6 AND dd = 19 AND y >= 2021) OR (m = 7 AND dd = 4)
      OR (m = 11 AND dd = 11) OR (m = 12 AND dd = 25)),
    holidays AS (SELECT d FROM fixed UNION SELECT d - 1 FROM fixed WHERE w = 6 UNION SELECT d + 1 FROM fixed WHERE w = 7
      UNION SELECT d FROM cal WHERE (w = 1 AND ((m IN (1, 2) AND dd BETWEEN 15 AND 21) OR (m = 5 AND dd >= 25)
        OR (m = 9 AND dd <= 7) OR (m = 10 AND dd BETWEEN 8 AND 14))) OR (m = 11 AND w = 4 AND dd BETWEEN 22 AND 28)
        OR (m = 2 AND dd = 12) OR (m = 2 AND dd = 15 AND y >= 2004) OR (m = 11 AND w = 2 AND dd BETWEEN 2 AND 8))"""


def holiday_sql(ts: str = "transit_timestamp") -> str:
    day = f"CAST({ts} AS DATE)"
    nov = lambda dow, lo, hi: f"CAST(month({ts}) = 11 AND isodow({ts}) = {dow} AND day({ts}) BETWEEN {lo} AND {hi} AS INTEGER)"
    inside = lambda shift: f"CAST({day} {shift} IN (SELECT d FROM holidays) AS INTEGER)"
    return f"""{inside("")} AS is_holiday, {inside("+ 1")} AS is_holiday_eve, {inside("- 1")} AS is_holiday_next,
      {nov(7, 1, 7)} AS is_nyc_marathon, {nov(3, 21, 27)} AS is_thanksgiving_eve, 0 AS is_pre_thanksgiving_saturday"""


@query("holiday_features", f"WITH {DD}, {calendar_sql(1994, 2002)} SELECT transit_timestamp, station_complex, ridership, {holiday_sql()} FROM dd")
def holiday_features(spark, sf_dir):
    return features.add_holiday_features(orders_hourly(spark, sf_dir), holiday_calendar(spark, 1994, 2002))


@query(
    "pre_thanksgiving_saturday",
    f"""WITH {DD} SELECT transit_timestamp, station_complex,
    CAST(month(transit_timestamp) = 11 AND isodow(transit_timestamp) = 6 AND day(transit_timestamp) BETWEEN 17 AND 23 AS INTEGER)
      AS is_pre_thanksgiving_saturday FROM dd""",
)
def pre_thanksgiving_saturday(spark, sf_dir):
    df = features.add_holiday_features(orders_hourly(spark, sf_dir), holiday_calendar(spark, 1994, 2002), offset_days=5)
    return df.select("transit_timestamp", "station_complex", "is_pre_thanksgiving_saturday")


@query("holiday_calendar", f"WITH {D}, {calendar_sql(1995, 2001)} SELECT DISTINCT d AS date FROM holidays WHERE year(d) BETWEEN (SELECT MIN(year(transit_timestamp)) FROM d) AND (SELECT MAX(year(transit_timestamp)) FROM d)")
def holiday_dates(spark, sf_dir):
    years = orders_hourly(spark, sf_dir).agg(F.min(F.year("transit_timestamp")), F.max(F.year("transit_timestamp"))).first()
    return holiday_calendar(spark, years[0], years[1])


# --- lags -----------------------------------------------------------------------------
def lag_sql(source: str, lags, means, stds, partition: str = "station_complex", digits: int = 6) -> str:
    over = f"PARTITION BY {partition} ORDER BY transit_timestamp"
    frame = lambda n: f"({over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    columns = [f"lag(ridership, {n}) OVER ({over}) AS lag_{n}" for n in lags]
    for kind, fn, sizes in (("mean", "avg", means), ("std", "stddev_samp", stds)):
        columns += [
            f"round(CASE WHEN count(ridership) OVER {frame(n)} >= {n // 2} THEN {fn}(ridership) OVER {frame(n)} END, {digits}) AS roll_{kind}_{n}"
            for n in sizes
        ]
    return f"SELECT *, {', '.join(columns)} FROM {source}"


MONTHLY = "station_complex, year(transit_timestamp), month(transit_timestamp)"
SHORT = dict(lags=(1, 7, 28), mean_windows=(7, 28), std_windows=(7,))
ROLLS = ["roll_mean_24", "roll_mean_168", "roll_std_24"]
H_LAGS = lag_sql("hh", (1, 24, 168), (24, 168), (24,))
H_MONTHLY = lag_sql("hh", (1, 24, 168), (24, 168), (24,), MONTHLY)


@query("lag_features", f"WITH {HH} {H_LAGS}")
def lag_features(spark, sf_dir):
    return rounded(features.add_lag_features(events_table(spark, sf_dir)), ROLLS)


@query("lag_features_short_chunks", f"WITH {HH} {H_LAGS}")
def lag_features_short_chunks(spark, sf_dir):
    return rounded(features.add_lag_features(events_table(spark, sf_dir), chunk_rows=200), ROLLS)


@query("lag_features_carried", f"WITH {HH} {H_LAGS}")
def lag_features_carried(spark, sf_dir):
    """The month in three instalments; each sees the one before it only through the carried rows."""
    hourly, carried, parts = events_table(spark, sf_dir), None, []
    for first, last in ((1, 10), (11, 20), (21, 31)):
        arrived = hourly.where(F.dayofmonth("transit_timestamp").between(first, last))
        made, carried = features.continue_lag_features(arrived, carried)
        parts.append(materialise(made, "features"))
        carried = materialise(carried, "carried")
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), ROLLS)


@query("lag_features_monthly", f"WITH {DD} {lag_sql('dd', (1, 7, 28), (7, 28), (7,), MONTHLY, 4)}")
def lag_features_monthly(spark, sf_dir):
    df = features.add_lag_features(orders_hourly(spark, sf_dir), reset_by="month", **SHORT)
    return rounded(df, ["roll_mean_7", "roll_mean_28", "roll_std_7"], 4)


@query(
    "drop_nulls",
    f"WITH {HH}, f AS ({H_MONTHLY}) SELECT * FROM f WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in LAG_FEATURES),
)
def drop_nulls(spark, sf_dir):
    lagged = features.add_lag_features(events_hourly(spark, sf_dir), reset_by="month")
    return rounded(features.drop_incomplete(lagged), ROLLS)


# --- labels ------------------------------------------------------------------------------
LIMITS = "lim AS (SELECT station_complex, quantile_cont(ridership, 0.8) AS threshold FROM {source} WHERE {where} GROUP BY 1)"
LATER = "lead(ridership, 2) OVER (PARTITION BY station_complex ORDER BY transit_timestamp)"


def label_sql(source: str, where: str = "TRUE", extra: str = "") -> str:
    return f"""SELECT x.* EXCLUDE (later), CAST(coalesce(later >= threshold, FALSE) AS INTEGER) AS is_congested
      FROM (SELECT *, {LATER} AS later FROM {source} WHERE {where}) x LEFT JOIN lim USING (station_complex) {extra}"""


@query("thresholds", f"WITH {HH}, {LIMITS.format(source='hh', where='TRUE')} SELECT station_complex, round(threshold, 6) AS threshold FROM lim")
def thresholds(spark, sf_dir):
    return rounded(labels.congestion_thresholds(events_table(spark, sf_dir)), ["threshold"])


@query(
    "thresholds_closed_brackets",
    f"""WITH {HH} SELECT station_complex, {", ".join(f"round(quantile_cont(ridership, {q}), 6) AS q{i}" for i, q in enumerate((0.05, 0.5, 0.8, 0.95)))}
    FROM hh GROUP BY 1""",
)
def thresholds_closed_brackets(spark, sf_dir):
    names = ["q0", "q1", "q2", "q3"]
    got = exact_quantiles(events_table(spark, sf_dir), ["station_complex"], "ridership", [0.05, 0.5, 0.8, 0.95], names, open_rows=0)
    return rounded(got, names)


@query("congestion_label", f"WITH {HH}, {LIMITS.format(source='hh', where='TRUE')} {label_sql('hh')}")
def congestion_label(spark, sf_dir):
    return labels.add_congestion_label(events_table(spark, sf_dir))


@query(
    "congestion_label_drop_tail",
    f"WITH {HH}, {LIMITS.format(source='hh', where='TRUE')} {label_sql('hh', extra='WHERE later IS NOT NULL')}",
)
def congestion_label_drop_tail(spark, sf_dir):
    return labels.add_congestion_label(events_table(spark, sf_dir), tail="drop", chunk_rows=150)


@query(
    "label_with_precomputed",
    f"""WITH {DD}, {LIMITS.format(source='dd', where="year(transit_timestamp) = 1999")}
    {label_sql('dd', where="year(transit_timestamp) = 2000")}""",
)
def label_with_precomputed(spark, sf_dir):
    hourly = orders_table(spark, sf_dir)
    year = F.year("transit_timestamp")
    limits = materialise(labels.congestion_thresholds(hourly.where(year == 1999)), "thresholds")
    return labels.add_congestion_label(hourly.where(year == 2000), thresholds=limits)


# --- stations ------------------------------------------------------------------------------
BRACKETS = r"regexp_extract_all({name}, '\(([^)]+)\)', 1)"


def entries_sql(name: str = "station_complex") -> str:
    return f"list_transform(flatten(list_transform({BRACKETS.format(name=name)}, lambda g: string_split(g, ','))), lambda l: trim(l))"


def num_lines_sql(name: str = "station_complex") -> str:
    return f"CAST(greatest(1, len({entries_sql(name)})) AS INTEGER)"


def lines_sql(name: str = "station_complex") -> str:
    return f"list_sort(list_distinct({entries_sql(name)}))"


def terminal_sql(name: str = "station_complex") -> str:
    hits = " OR ".join(f"contains(lower({name}), '{t.lower()}')" for t in TERMINAL_STATIONS)
    return f"CAST(({hits}) AS INTEGER)"


BOROUGH_SQL = ", ".join(f"CAST(borough = '{b}' AS INTEGER) AS {flag}" for flag, b in zip(BOROUGH_FLAGS, BOROUGHS))
TIER_SQL = """edges AS (SELECT quantile_cont(avg_ridership, 0.25) AS e1, quantile_cont(avg_ridership, 0.5) AS e2,
  quantile_cont(avg_ridership, 0.75) AS e3 FROM profile)"""
TIER_CASE = "CASE WHEN avg_ridership <= e1 THEN 1 WHEN avg_ridership <= e2 THEN 2 WHEN avg_ridership <= e3 THEN 3 ELSE 4 END"
STATIONS = f"""{PROFILE.format(source="h", years="2024")}, {TIER_SQL},
  st AS (SELECT profile.*, {num_lines_sql()} AS num_lines, {terminal_sql()} AS is_terminal, {BOROUGH_SQL},
    {TIER_CASE} AS station_tier FROM profile, edges)"""
MEANS = ["avg_ridership", "std_ridership"]


def event_stations(spark, sf_dir):
    return stations.build_station_features(hourly_events(spark, sf_dir), (2024,))


@query("station_features", f"WITH {H}, {STATIONS} SELECT * REPLACE ({rounds(MEANS)}) FROM st")
def station_features(spark, sf_dir):
    return rounded(event_stations(spark, sf_dir), MEANS)


@query(
    "merge_station_features",
    f"""WITH {HH}, {STATIONS} SELECT hh.*, {", ".join(f"round({c}, 6) AS {c}" if c in MEANS else c for c in STATION_FEATURES)}
    FROM hh LEFT JOIN st USING (station_complex)""",
)
def merge_station_features(spark, sf_dir):
    return rounded(stations.merge_station_features(events_hourly(spark, sf_dir), event_stations(spark, sf_dir)), MEANS)


@query(
    "station_tier",
    f"""WITH {D}, {PROFILE.format(source="d", years="1999, 2000")}, {TIER_SQL}
    SELECT station_complex, round(avg_ridership, 6) AS avg_ridership, {TIER_CASE} AS station_tier FROM profile, edges""",
)
def station_tier(spark, sf_dir):
    df = stations.build_station_features(orders_view(spark, sf_dir), (1999, 2000))
    return rounded(df.select("station_complex", "avg_ridership", "station_tier"), ["avg_ridership"])


NAMED = "names AS (SELECT DISTINCT station_complex FROM h UNION SELECT station_complex FROM p)"


def all_names(spark, sf_dir):
    h = hourly_events(spark, sf_dir).select("station_complex").distinct()
    return h.unionByName(part_names(spark, sf_dir).select("station_complex")).distinct()


@query("num_lines", f"WITH {H}, {P}, {NAMED} SELECT station_complex, {num_lines_sql()} AS num_lines FROM names")
def num_lines(spark, sf_dir):
    return all_names(spark, sf_dir).withColumn("num_lines", names.num_lines(F.col("station_complex")))


@query("extract_lines", f"WITH {H}, {P}, {NAMED} SELECT station_complex, array_to_string({lines_sql()}, ',') AS lines FROM names")
def extract_lines(spark, sf_dir):
    listed = names.lines(F.col("station_complex"))
    return all_names(spark, sf_dir).withColumn("lines", F.array_join(listed, ","))


@query("terminal_flag", f"WITH {H}, {P}, {NAMED} SELECT station_complex, {terminal_sql()} AS is_terminal FROM names")
def terminal_flag(spark, sf_dir):
    return all_names(spark, sf_dir).withColumn("is_terminal", names.is_terminal(F.col("station_complex")))


@query(
    "borough_flags",
    f"WITH {H} SELECT station_complex, {BOROUGH_SQL}, COUNT(*) AS records, borough AS borough_from_flags FROM h GROUP BY station_complex, borough",
)
def borough_flags(spark, sf_dir):
    flagged = hourly_events(spark, sf_dir).select("station_complex", *names.borough_flags(F.col("borough")))
    counted = flagged.groupBy("station_complex", *BOROUGH_FLAGS).agg(F.count("*").alias("records"))
    return counted.withColumn("borough_from_flags", names.borough_from_flags())


@query(
    "tier_summary",
    f"""WITH {H}, {STATIONS} SELECT station_tier, COUNT(*) AS stations, MIN(num_lines) AS min_lines, MAX(num_lines) AS max_lines,
    CAST(SUM(is_terminal) AS BIGINT) AS terminals FROM st GROUP BY 1""",
)
def tier_summary(spark, sf_dir):
    return stations.tier_summary(event_stations(spark, sf_dir))


META = f"meta AS (SELECT station_complex, borough, num_lines, station_tier, {lines_sql()} AS lines FROM st)"


@query("station_meta", f"WITH {H}, {STATIONS}, {META} SELECT * REPLACE (array_to_string(lines, ',') AS lines) FROM meta")
def station_meta(spark, sf_dir):
    return stations.station_meta(event_stations(spark, sf_dir)).withColumn("lines", F.array_join("lines", ","))


@query("all_lines", f"WITH {H}, {STATIONS}, {META} SELECT DISTINCT unnest(lines) AS line FROM meta ORDER BY 1")
def all_lines(spark, sf_dir):
    return stations.all_lines(stations.station_meta(event_stations(spark, sf_dir)))


@query(
    "filter_stations",
    f"""WITH {H}, {STATIONS}, {META} SELECT * REPLACE (array_to_string(lines, ',') AS lines) FROM meta
    WHERE num_lines >= 3 AND list_contains(lines, 'S')""",
)
def filter_stations(spark, sf_dir):
    meta = stations.station_meta(event_stations(spark, sf_dir))
    return stations.filter_stations(meta, line_count="3+", line="S").withColumn("lines", F.array_join("lines", ","))


@query(
    "search_station",
    f"""WITH {H}, {P}, {NAMED} SELECT station_complex FROM names WHERE contains(lower(station_complex), 'pl')
    ORDER BY CAST(lower(station_complex) = 'pl' AS INTEGER) DESC, station_complex LIMIT 1""",
)
def search_station(spark, sf_dir):
    return stations.find_station(all_names(spark, sf_dir), " PL ")


@query(
    "suggest_stations",
    f"WITH {H}, {P}, {NAMED} SELECT station_complex FROM names WHERE contains(lower(station_complex), 'ar') ORDER BY 1 LIMIT 20",
)
def suggest_stations(spark, sf_dir):
    return stations.suggest_stations(all_names(spark, sf_dir), "Ar")


@query(
    "repeated_names",
    f"WITH {D} SELECT borough AS station_complex, COUNT(DISTINCT station_complex_id) AS n FROM d GROUP BY 1 HAVING COUNT(DISTINCT station_complex_id) > 1",
)
def repeated_names(spark, sf_dir):
    listed = orders_view(spark, sf_dir).select(F.col("borough").alias("station_complex"), "station_complex_id").distinct()
    return stations.repeated_names(listed)


# --- names ------------------------------------------------------------------------------
NORMALISED = """concat(split_part(station_complex, '(', 1), '(',
  array_to_string(list_sort(list_transform(string_split(split_part(split_part(station_complex, '(', 2), ')', 1), ','), lambda l: trim(l))), ','), ')')"""


@query("normalise_names", f"WITH {P} SELECT station_complex, {NORMALISED} AS form FROM p")
def normalise_names(spark, sf_dir):
    return part_names(spark, sf_dir).select("station_complex", names.sort_line_letters(F.col("station_complex")).alias("form"))


@query(
    "dedup_stations",
    f"""WITH {P}, ranked AS (SELECT *, row_number() OVER (PARTITION BY {NORMALISED}
      ORDER BY known DESC, length(station_complex) DESC, station_complex) AS rn FROM p)
    SELECT station_complex, round(prob, 6) AS prob, n, known FROM ranked WHERE rn = 1""",
)
def dedup_stations(spark, sf_dir):
    frame = part_names(spark, sf_dir)
    return rounded(stations.deduplicate_stations(frame, frame.where("known")), ["prob"])


@query(
    "renamed_stations",
    f"""WITH {P}, renamed AS (SELECT *, CASE station_complex WHEN 'PROMO (C,1,A)' THEN 'PROMO (A,C,1)'
        WHEN 'LARGE (A,C,1)' THEN 'Large St (1)' ELSE station_complex END AS name FROM p),
    one AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY station_complex <> name, station_complex) AS rn FROM renamed)
    SELECT name AS station_complex, round(prob, 6) AS prob, n FROM one WHERE rn = 1""",
)
def renamed_stations(spark, sf_dir):
    aliases = {"PROMO (C,1,A)": "PROMO (A,C,1)", "LARGE (A,C,1)": "Large St (1)"}
    frame = part_names(spark, sf_dir).select("station_complex", "prob", "n")
    renamed = stations.rename_stations(frame, aliases)
    return rounded(renamed, ["prob"])


# --- the whole feature matrix -------------------------------------------------------------
@query(
    "feature_matrix",
    f"""WITH {HH}, {STATIONS}, {calendar_sql(2023, 2025)}, f AS ({H_MONTHLY}),
    g AS (SELECT * FROM f WHERE {" AND ".join(f"{c} IS NOT NULL" for c in LAG_FEATURES)})
    SELECT g.*, {time_sql()}, {holiday_sql()}, {", ".join(f"round(st.{c}, 6) AS {c}" if c in MEANS else "st." + c for c in STATION_FEATURES)}
    FROM g LEFT JOIN st USING (station_complex)""",
)
def feature_matrix(spark, sf_dir):
    df = build_features(hourly_events(spark, sf_dir), "2024-01-01", "2024-02-01", event_stations(spark, sf_dir))
    return rounded(df, [*ROLLS, *WAVES, *MEANS])
