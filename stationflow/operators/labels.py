"""Busy-ahead labels from per-station thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.functions.timeparts import month_floor
from stationflow.operators.ordered import in_chunks
from stationflow.operators.quantiles import exact_quantiles
from stationflow.schema import RIDERSHIP, STATION, TARGET_COL, TS
from stationflow.session import materialise


def congestion_thresholds(df: DataFrame, threshold: float = 0.8, station_col: str = STATION) -> DataFrame:
    """The ridership each station stays below `threshold` of the time."""
    return exact_quantiles(df, [station_col], RIDERSHIP, [threshold], ["threshold"])


def mark_ahead(df: DataFrame, horizon: int, station_col: str = STATION, ts: str = TS, month: str | None = None) -> DataFrame:
    """Add `_later`, the ridership `horizon` rows later in the same month, and `_after`, how many of those rows the month still has.

    `month` names a column with the month where there is one. The window is that of lag features which were reset by it:
    after them it needs neither a shuffle nor a sort.
    """
    series = Window.partitionBy(station_col, F.col(month) if month else month_floor(F.col(ts))).orderBy(ts)
    ahead = F.count(F.lit(1)).over(series.rowsBetween(1, horizon))
    return df.withColumns({"_later": F.lead(F.struct(RIDERSHIP), horizon).over(series), "_after": ahead.cast("int")})


def following_rows(df: DataFrame, horizon: int, station_col: str = STATION, ts: str = TS) -> DataFrame:
    """(station, month, following): the ridership of the first `horizon` rows after each station's month.

    Only the first `horizon` rows of each station and month are shuffled. The result has a row a station and month.
    """
    narrow = df.select(F.col(station_col).alias("_station"), month_floor(F.col(ts)).alias("_month"), F.col(ts).alias("_ts"), RIDERSHIP)
    place = F.row_number().over(Window.partitionBy("_station", "_month").orderBy("_ts"))
    first = narrow.withColumn("_place", place).where(F.col("_place") <= horizon)
    heads = first.groupBy("_station", "_month").agg(F.array_sort(F.collect_list(F.struct("_place", RIDERSHIP))).alias("_head"))
    # Every month has a row at least, so `horizon` months hold enough.
    later = F.flatten(F.collect_list("_head").over(Window.partitionBy("_station").orderBy("_month").rowsBetween(1, horizon)))
    return heads.select("_station", "_month", F.slice(F.transform(later, lambda x: F.struct(x[RIDERSHIP].alias(RIDERSHIP))), 1, horizon).alias("_following"))


def label_marked(df: DataFrame, thresholds: DataFrame, horizon: int, station_col: str = STATION, tail: str = "zero", ts: str = TS) -> DataFrame:
    """The label of a frame with `_later` and `_after`, which go.

    The last rows of a month look at the first rows of the station's next months in `df`. They come as a small table,
    so the rows themselves are joined where they are.
    """
    given = [c for c in df.columns if c not in ("_later", "_after")]
    beyond = materialise(following_rows(df, horizon, station_col, ts), "following")
    same = F.col(station_col).eqNullSafe(F.col("_station")) & month_floor(F.col(ts)).eqNullSafe(F.col("_month"))
    missing = F.lit(horizon) - F.col("_after")
    later = F.when(missing > 0, F.try_element_at("_following", missing)).otherwise(F.col("_later"))
    ahead = df.join(beyond, same, "left").withColumn("_later", later).drop("_station", "_month", "_following", "_after")
    return _judge(ahead, thresholds, station_col, tail, given)


def _judge(ahead: DataFrame, thresholds: DataFrame, station_col: str, tail: str, given: list[str]) -> DataFrame:
    limits = thresholds.select(F.col(station_col).alias("_station"), F.col("threshold").alias("_threshold"))
    if tail == "drop":
        ahead = ahead.where(F.col("_later").isNotNull())
    reached = F.col(f"_later.{RIDERSHIP}") >= F.col("_threshold")
    return (
        ahead.join(limits, F.col(station_col) == F.col("_station"), "left")
        .withColumn(TARGET_COL, F.coalesce(reached, F.lit(False)).cast("int"))
        .select(*given, TARGET_COL)
    )


def add_congestion_label(
    df: DataFrame, threshold: float = 0.8, horizon: int = 2, station_col: str = STATION,
    thresholds: DataFrame | None = None, tail: str = "zero", ts: str = TS, chunk_rows: int | None = None,
) -> DataFrame:
    """1 where ridership `horizon` rows later reaches the station's threshold.

    `thresholds` (station, threshold) keeps a test set on training thresholds;
    without it they come from `df`, which is then written once, so that thresholds and rows come from one
    run. Stations without a threshold get 0. The last
    `horizon` rows of a station have no later value: they get 0, or are left
    out with `tail="drop"`. Rows meet by station and month (744 rows of an hourly series); `chunk_rows` is for series
    whose months are longer: it deals them in chunks of so many rows, at the price of two shuffles.
    """
    if tail not in ("zero", "drop"):
        raise ValueError("tail is 'zero' or 'drop'")
    given = df.columns
    if thresholds is None:
        df = materialise(df, "unlabelled")
        thresholds = materialise(congestion_thresholds(df, threshold, station_col), "thresholds")
    if chunk_rows is None:
        return label_marked(mark_ahead(df, horizon, station_col, ts), thresholds, horizon, station_col, tail, ts)
    work = in_chunks(df, [station_col], ts, after=horizon, chunk_rows=chunk_rows)
    series = Window.partitionBy(station_col, "_chunk").orderBy("_row")
    ahead = work.withColumn("_later", F.lead(F.struct(RIDERSHIP), horizon).over(series)).where("_own")
    return _judge(ahead, thresholds, station_col, tail, given)
