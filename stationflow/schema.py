"""Column names, schemas and fixed values shared by the whole library."""

from __future__ import annotations

from pyspark.sql import types as T

TS = "transit_timestamp"
STATION = "station_complex"
STATION_ID = "station_complex_id"
BOROUGH = "borough"
RIDERSHIP = "ridership"

# Landed records carry every number as text, exactly as the feed delivers it.
# `georeference` is left out of the schema, so the reader never parses it.
LANDED_TEXT = [
    TS,
    STATION_ID,
    STATION,
    BOROUGH,
    "payment_method",
    RIDERSHIP,
    "transfers",
    "latitude",
    "longitude",
]
NUMERIC_TEXT = [RIDERSHIP, "transfers", "latitude", "longitude"]


def landed_schema(extra: list[str] | None = None) -> T.StructType:
    """Schema of landed records; `extra` names further text columns to keep."""
    return T.StructType([T.StructField(c, T.StringType()) for c in LANDED_TEXT + (extra or [])])


def fact_schema(extra: list[str] | None = None) -> T.StructType:
    """Schema of the `ridership` fact without its partition columns."""
    typed = {TS: T.TimestampNTZType(), **{c: T.DoubleType() for c in NUMERIC_TEXT}}
    return T.StructType(
        [T.StructField(c, typed.get(c, T.StringType())) for c in LANDED_TEXT + (extra or [])]
    )


PARTITION_COLS = ["year", "month"]
BATCH_COL = "ingest_batch"

# --- Fixed values: feature names the model is trained on -----------------------
WEEKDAY_FLAGS = ["day_mon", "day_tue", "day_wed", "day_thu", "day_fri", "day_sat", "day_sun"]
TIME_FEATURES = [
    "hour", "day_of_week", "month", "week_of_year", "is_weekend", "is_shoulder_day",
    *WEEKDAY_FLAGS,
    "hour_sin", "hour_cos", "month_sin", "month_cos",
]
LAG_FEATURES = ["lag_1", "lag_24", "lag_168", "roll_mean_24", "roll_mean_168", "roll_std_24"]
HOLIDAY_FEATURES = [
    "is_holiday", "is_holiday_eve", "is_holiday_next",
    "is_nyc_marathon", "is_thanksgiving_eve", "is_pre_thanksgiving_saturday",
]
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]
BOROUGH_FLAGS = ["borough_" + b.lower().replace(" ", "_") for b in BOROUGHS]
STATION_FEATURES = [
    "num_lines", "is_terminal", "avg_ridership", "std_ridership", "max_ridership", "station_tier",
    *BOROUGH_FLAGS,
]
FEATURE_COLS = TIME_FEATURES + LAG_FEATURES + HOLIDAY_FEATURES + STATION_FEATURES
TARGET_COL = "is_congested"

# --- Fixed values: names of the stations where lines end ------------------------
TERMINAL_STATIONS = [
    "8 Av (L)",
    "Bay Ridge-95 St (R)",
    "Canarsie-Rockaway Pkwy (L)",
    "Coney Island-Stillwell Av (D,F,N,Q)",
    "Eastchester-Dyre Av (5)",
    "Far Rockaway-Mott Av (A)",
    "Flatbush Av-Brooklyn College (2,5)",
    "Flushing-Main St (7)",
    "Forest Hills-71 Av (E,F,M,R)",
    "Howard Beach-JFK Airport (A)",
    "Inwood-207 St (A)",
    "Jamaica Center-Parsons/Archer (E,J,Z)",
    "Jamaica-179 St (F)",
    "Jamaica-Van Wyck (E)",
    "Nereid Av (2,5)",
    "New Lots Av (3)",
    "New Utrecht Av (N)/62 St (D)",
    "Norwood-205 St (D)",
    "Ozone Park-Lefferts Blvd (A)",
    "Pelham Bay Park (6)",
    "Rockaway Park-Beach 116 St (A,S)",
    "Wakefield-241 St (2)",
    "Woodlawn (4)",
]

# --- Fixed values: renamed stations, old name -> name to keep -------------------
STATION_ALIASES = {
    "5 Av/53 St (E,F)": "5 Av/53 St (E,M)",
    "Alabama Av (J,Z)": "Alabama Av (J)",
    "Lexington Av/63 St (F,Q)": "Lexington Av/63 St (M,Q)",
    "Queens Plaza (E,F,R)": "Queens Plaza (E,M,R)",
}
