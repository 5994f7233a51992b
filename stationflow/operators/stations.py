"""Station dimension: features, tiers, names, filters and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions import names
from stationflow.operators.quantiles import exact_quantiles
from stationflow.operators.rollups import station_profile
from stationflow.schema import BOROUGH, STATION, STATION_FEATURES
from stationflow.session import materialise


def add_station_tier(df: DataFrame, value: str = "avg_ridership") -> DataFrame:
    """Quartile 1 (smallest) to 4 of a value over all stations.

    Edges are interpolated quartiles and belong to the lower tier. Equal edges
    leave no distinct quartiles and raise an error.
    """
    edges = exact_quantiles(
        df, [], value, [0, 0.25, 0.5, 0.75, 1], ["e0", "e1", "e2", "e3", "e4"]
    ).select(F.array("e0", "e1", "e2", "e3", "e4").alias("e")).scalar()
    e, x = F.col("_edges"), F.col(value).cast("double")
    distinct = F.size(F.array_distinct(e)) == 5
    tier = F.when(x <= e[1], 1).when(x <= e[2], 2).when(x <= e[3], 3).when(x.isNotNull(), 4)
    return (
        df.withColumn("_edges", edges)
        .withColumn(
            "station_tier",
            F.when(distinct, tier).otherwise(F.raise_error(F.lit("tier edges must be unique")).cast("int")),
        )
        .drop("_edges")
    )


def build_station_features(df: DataFrame, years: tuple[int, ...] = (2023, 2024)) -> DataFrame:
    """One row of static features per (station, id, borough).

    The profile is written before tiers are cut: tier edges and the values they
    are compared with must come from the same sums.
    """
    name = F.col(STATION)
    profile = station_profile(df, years).select(
        "*",
        names.num_lines(name).alias("num_lines"),
        names.is_terminal(name).alias("is_terminal"),
        *names.borough_flags(F.col(BOROUGH)),
    )
    return add_station_tier(materialise(profile, "stations"))


def merge_station_features(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of the model's station features by name.

    A name listed under several ids yields one row per id; see `repeated_names`.
    """
    return df.join(stations.select(STATION, *STATION_FEATURES), STATION, "left")


def repeated_names(stations: DataFrame) -> DataFrame:
    """Names that would fan out in `merge_station_features`."""
    return stations.groupBy(STATION).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def tier_summary(stations: DataFrame) -> DataFrame:
    return stations.groupBy("station_tier").agg(
        F.count(F.lit(1)).alias("stations"),
        F.min("num_lines").alias("min_lines"),
        F.max("num_lines").alias("max_lines"),
        F.sum("is_terminal").alias("terminals"),
    )


def station_meta(stations: DataFrame) -> DataFrame:
    """What filters and maps show of a station."""
    return stations.select(
        STATION,
        names.borough_from_flags().alias("borough"),
        "num_lines",
        "station_tier",
        names.lines(F.col(STATION)).alias("lines"),
    )


def all_lines(meta: DataFrame) -> DataFrame:
    return meta.select(F.explode("lines").alias("line")).distinct().orderBy("line")


def filter_stations(
    meta: DataFrame, borough: str | None = None, tier: int | None = None, line_count: str | None = None,
    line: str | None = None,
) -> DataFrame:
    """Optional filters: borough, tier, number of lines (`1`, `2`, `3+`), a line served."""
    if borough is not None:
        meta = meta.where(F.col("borough") == borough)
    if tier is not None:
        meta = meta.where(F.col("station_tier") == tier)
    if line_count is not None:
        wanted = F.col("num_lines") >= 3 if line_count == "3+" else F.col("num_lines") == int(line_count)
        meta = meta.where(wanted)
    if line is not None:
        meta = meta.where(F.array_contains("lines", line))
    return meta


def _contains(query: str) -> tuple[Column, str]:
    wanted = query.lower().strip()
    return F.contains(F.lower(F.col(STATION)), F.lit(wanted)), wanted


def find_station(stations: DataFrame, query: str) -> DataFrame:
    """The station meant by a typed text: equal but for case, else the first that contains it."""
    hit, wanted = _contains(query)
    exact = (F.lower(F.col(STATION)) == wanted).cast("int")
    return stations.where(hit).select(STATION).orderBy(exact.desc(), STATION).limit(1)


def suggest_stations(stations: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Type-ahead list: names containing a text of two letters or more."""
    hit, wanted = _contains(query)
    return stations.where(hit & F.lit(len(wanted) >= 2)).select(STATION).orderBy(STATION).limit(limit)


def _after_renaming(stations: DataFrame, aliases: dict[str, str] | None) -> DataFrame:
    """Each name after renaming (`_name`) and the one source name (`_source`) it
    takes its rows from: the canonical name's own rows where they exist."""
    source = stations.select(F.col(STATION).alias("_source")).distinct()
    renamed = source.withColumn("_name", names.canonical_name(F.col("_source"), aliases))
    preference = F.struct((F.col("_source") != F.col("_name")).cast("int"), F.col("_source"))
    return renamed.groupBy("_name").agg(F.min_by("_source", preference).alias("_source"))


def _take(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """The rows of the mapped source names, under their new name."""
    columns = [F.col("_name").alias(STATION) if c == STATION else F.col(c) for c in df.columns]
    return df.join(mapping, F.col(STATION) == F.col("_source")).select(*columns)


def rename_stations(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Give renamed stations their canonical name."""
    return _take(df, materialise(_after_renaming(df, aliases), "names"))


def best_names(stations: DataFrame, known: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Map each name to keep (`_name`) to the source name whose rows it takes.

    After renaming, names equal but for the order of their line letters are one
    station: a known name is kept first, else the longest, ties by name. Works
    on distinct names with aggregates only, no window over a group.
    """
    listed = known.select(F.col(STATION).alias("_known")).distinct()
    marked = _after_renaming(stations, aliases).join(listed, F.col("_name") == F.col("_known"), "left")
    rank = F.struct(F.col("_known").isNull().cast("int"), -F.length("_name"), F.col("_name"))
    return (
        marked.groupBy(names.sort_line_letters(F.col("_name")).alias("_form"))
        .agg(F.min_by(F.struct("_source", "_name"), rank).alias("_best"))
        .select("_best._source", "_best._name")
    )


def deduplicate_stations(df: DataFrame, known: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Keep one name per station in a frame of predictions."""
    return _take(df, materialise(best_names(df, known, aliases), "names"))
