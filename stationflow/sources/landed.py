"""Landed source pages (JSON) and their cleaning into the typed fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stationflow.operators.ordered import running_sum
from stationflow.schema import NUMERIC_TEXT, TS, landed_schema
from stationflow.sources.facts import select_range

ISO_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?$"


def read_landed(spark: SparkSession, path: str | list[str], extra: list[str] | None = None, lines: bool = False) -> DataFrame:
    """Landed pages as text columns. A page is one JSON array of records, or
    JSON lines with `lines=True`. Nested and unknown fields are not parsed."""
    return (
        spark.read.schema(landed_schema(extra))
        .option("multiLine", str(not lines).lower())
        .option("mode", "FAILFAST")
        .json(path)
    )


def clean(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Text to types: ISO timestamp with optional fraction, numbers to double.

    A timestamp without a time of day, with a zone or with spaces around it is bad.
    A bad value fails the job. With `on_error="mark"` it becomes NULL and the
    row is flagged in `is_bad`, so that bad rows can be set aside.
    """
    if on_error not in ("fail", "mark"):
        raise ValueError("on_error is 'fail' or 'mark'")
    types = {TS: "timestamp_ntz", **{c: "double" for c in NUMERIC_TEXT if c in df.columns}}

    def lenient(name: str, to: str) -> Column:
        soft = F.col(name).try_cast(to)
        return F.when(F.col(name).rlike(ISO_TEXT), soft) if name == TS else soft

    def strict(name: str, to: str) -> Column:
        soft = lenient(name, to)
        wrong = F.col(name).isNotNull() & soft.isNull()
        message = F.concat(F.lit(f"bad {name}: "), F.col(name))
        return F.when(wrong, F.raise_error(message).cast(to)).otherwise(soft)

    convert = strict if on_error == "fail" else lenient
    out = df.withColumns({name: convert(name, to) for name, to in types.items()})
    if on_error == "mark":
        bad = [F.col(n).isNotNull() & lenient(n, to).isNull() for n, to in types.items()]
        flagged = df.withColumn("is_bad", F.greatest(*[b.cast("int") for b in bad]) == 1)
        out = flagged.withColumns({name: convert(name, to) for name, to in types.items()})
    return out.drop("georeference")


def select_page(df: DataFrame, start: str | None = None, end: str | None = None, limit: int = 50_000, offset: int = 0) -> DataFrame:
    """One page of a range in time order, ties by the remaining columns.

    Counts per timestamp tell which timestamps a page touches; only their rows are put in order.
    """
    ranged = select_range(df, None, start, end)
    ties = [c for c in ranged.columns if c != TS]
    counts = ranged.groupBy(TS).agg(F.count(F.lit(1)).alias("_n"))
    day = F.substring(F.col(TS).cast("string"), 1, 10)
    ends = running_sum(counts, [], [TS], day, F.col("_n"), "_end")
    before = F.col("_end") - F.col("_n")
    touched = ends.where((F.col("_end") > offset) & (before < offset + limit)).select(F.col(TS).alias("_ts"), before.alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(TS).orderBy(*(ties or [TS])))
    placed = ranged.join(touched, F.col(TS).eqNullSafe(F.col("_ts"))).withColumn("_place", place)
    return placed.where((F.col("_place") > offset) & (F.col("_place") <= offset + limit)).select(*ranged.columns).orderBy(TS, *ties)


def newer_than(df: DataFrame, watermark: str | None, start: str) -> DataFrame:
    """Rows after the high-water mark, or from `start` on the first run."""
    at = F.col(TS).cast("timestamp_ntz")
    if watermark is not None:
        return df.where(at > F.lit(watermark).cast("timestamp_ntz"))
    return df.where(at >= F.lit(start).cast("timestamp_ntz"))
