"""Time, lag and holiday features of an hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.functions import holidays
from stationflow.functions.timeparts import cycle, dow_monday0, month_floor
from stationflow.operators.ordered import CHUNK_ROWS, in_chunks
from stationflow.schema import LAG_FEATURES, RIDERSHIP, STATION, TS, WEEKDAY_FLAGS


def add_time_features(df: DataFrame, ts: str = TS) -> DataFrame:
    """17 calendar features; weekdays count from Monday = 0."""
    at = F.col(ts)
    dow, hour, month = dow_monday0(at), F.hour(at), F.month(at)
    hour_sin, hour_cos = cycle(hour, 24)
    month_sin, month_cos = cycle(month, 12)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": dow,
            "month": month,
            "week_of_year": F.weekofyear(at),
            "is_weekend": dow.isin(5, 6).cast("int"),
            "is_shoulder_day": dow.isin(0, 4).cast("int"),
            **{flag: (dow == i).cast("int") for i, flag in enumerate(WEEKDAY_FLAGS)},
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "month_sin": month_sin,
            "month_cos": month_cos,
        }
    )


def add_lag_features(
    df: DataFrame, station_col: str = STATION, ts: str = TS, value: str = RIDERSHIP,
    lags: Sequence[int] = (1, 24, 168), mean_windows: Sequence[int] = (24, 168), std_windows: Sequence[int] = (24,),
    reset_by: str | None = None, chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Earlier values and rolling statistics per station, counted in rows.

    The current row is not part of its own rolling windows; a window needs half
    its rows. `reset_by="month"` starts each station anew every calendar month, the name of a column
    with each of its values (of which each has few rows a station).
    All features share one sort. Continuous series are worked on in overlapping
    chunks, so a long series is spread over tasks; `chunk_rows=None` turns that
    off where every series is known to be short.
    """
    if reset_by not in (None, "month", *df.columns):
        raise ValueError("reset_by is None, 'month' or a column")
    given = df.columns
    reach = max([*lags, *mean_windows, *std_windows])
    if reset_by is not None:
        # a month of hours is at most 744 rows per station
        part = month_floor(F.col(ts)) if reset_by == "month" else F.col(reset_by)
        series = Window.partitionBy(station_col, part).orderBy(ts)
        work, keep = df, None
    elif chunk_rows is None:
        series = Window.partitionBy(station_col).orderBy(ts)
        work, keep = df, None
    else:
        work, keep = in_chunks(df, [station_col], ts, before=reach, chunk_rows=chunk_rows), "_own"
        series = Window.partitionBy(station_col, "_chunk").orderBy("_row")

    x = F.col(value)

    def rolling(stat, n: int):
        frame = series.rowsBetween(-n, -1)
        return F.when(F.count(x).over(frame) >= n // 2, stat(x).over(frame))

    features = {f"lag_{n}": F.lag(x, n).over(series) for n in lags}
    features |= {f"roll_mean_{n}": rolling(F.avg, n) for n in mean_windows}
    features |= {f"roll_std_{n}": rolling(F.stddev_samp, n) for n in std_windows}
    out = work.withColumns(features)
    if keep:
        out = out.where(keep)
    return out.select(*given, *features)


def carried_rows(df: DataFrame, rows: int, station_col: str = STATION, ts: str = TS) -> DataFrame:
    """The last `rows` rows of each station: what the lags of later rows can reach. Tasks hand on so many rows a station at most."""
    place = F.row_number().over(Window.partitionBy(station_col).orderBy(F.desc(ts)))
    return df.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")


def continue_lag_features(
    arrived: DataFrame, carried: DataFrame | None, station_col: str = STATION, ts: str = TS, value: str = RIDERSHIP,
    lags: Sequence[int] = (1, 24, 168), mean_windows: Sequence[int] = (24, 168), std_windows: Sequence[int] = (24,),
    chunk_rows: int | None = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Lag features of rows that arrived after all others, and what to carry to the next ones.

    `carried` (station, time, value) is what the last call returned, None on the first. The features are those of `add_lag_features` over the
    whole history without a reset, from the arrived and the carried rows alone. A station that pauses keeps its rows.
    """
    narrow = [station_col, ts, value]
    fresh = arrived.withColumn("_fresh", F.lit(True))
    before = carried.select(*narrow, F.lit(False).alias("_fresh")) if carried is not None else None
    both = fresh if before is None else fresh.unionByName(before, allowMissingColumns=True)
    made = add_lag_features(both, station_col, ts, value, lags, mean_windows, std_windows, None, chunk_rows)
    reach = max([*lags, *mean_windows, *std_windows])
    return made.where("_fresh").drop("_fresh"), carried_rows(both.select(*narrow), reach, station_col, ts)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = tuple(LAG_FEATURES)) -> DataFrame:
    """Drop rows whose lag features are not all there yet."""
    return df.dropna(subset=list(columns))


def add_holiday_features(df: DataFrame, calendar: DataFrame, ts: str = TS, offset_days: int = 8) -> DataFrame:
    """Six flags for holidays, the days around them and three November dates.

    `calendar` has one row `date` per holiday. It is spread to flags per date
    first, so the fact meets a single small table once.
    """
    around = F.array(
        F.struct(F.col("date").alias("d"), F.lit(1).alias("h"), F.lit(0).alias("e"), F.lit(0).alias("n")),
        F.struct(F.date_sub("date", 1).alias("d"), F.lit(0).alias("h"), F.lit(1).alias("e"), F.lit(0).alias("n")),
        F.struct(F.date_add("date", 1).alias("d"), F.lit(0).alias("h"), F.lit(0).alias("e"), F.lit(1).alias("n")),
    )
    flags = (
        calendar.select(F.inline(around))
        .groupBy(F.col("d").alias("_flag_date"))
        .agg(F.max("h").alias("_h"), F.max("e").alias("_e"), F.max("n").alias("_n"))
    )
    day = F.col(ts).cast("date")
    year = F.year(day)

    def flag(condition):
        return F.coalesce(condition, F.lit(False)).cast("int")

    return (
        df.join(flags, day == F.col("_flag_date"), "left")
        .withColumns(
            {
                "is_holiday": F.coalesce("_h", F.lit(0)),
                "is_holiday_eve": F.coalesce("_e", F.lit(0)),
                "is_holiday_next": F.coalesce("_n", F.lit(0)),
                "is_nyc_marathon": flag(day == holidays.marathon_day(year)),
                "is_thanksgiving_eve": flag(day == F.date_sub(holidays.thanksgiving(year), 1)),
                "is_pre_thanksgiving_saturday": flag(day == holidays.pre_thanksgiving_saturday(year, offset_days)),
            }
        )
        .drop("_flag_date", "_h", "_e", "_n")
    )
