"""Batch ingest: month planning, completeness, backfill, incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.schema import PARTITION_COLS, TS
from stationflow.session import materialise, scratch_path
from stationflow.sources.facts import partition_keys
from stationflow.sources.landed import newer_than
from stationflow.sources.sinks import append_months, get_watermark, newest_in_batch, replace_months, set_watermark

# --- Fixed value: a month with fewer rows is taken for incomplete ------------------
COMPLETE_MONTH_ROWS = 500_000


def month_plan(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Half-open month ranges [start, end) of the given years, inclusive."""
    first, last = F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-01").cast("date")
    months = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("d"))
    midnight = lambda d: d.cast("timestamp_ntz")
    return months.select(
        midnight(F.col("d")).alias("start"),
        midnight(F.add_months("d", 1)).alias("end"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
    )


def month_counts(ridership: DataFrame) -> DataFrame:
    """Rows per stored month; needs the partition columns only."""
    return ridership.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n"))


def footer_scan(spark: SparkSession, root: str) -> DataFrame:
    """A plain year/month table in a session of its own, whose scans take counts per partition from the Parquet footers.

    Only the newer Parquet reader does so; the caller's session keeps its reader.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.schema(f"{TS} timestamp_ntz, year int, month int").parquet(root)


def month_counts_from_footers(spark: SparkSession, root: str) -> DataFrame:
    """Rows per stored month of a plain year/month table; no row is read."""
    counts = month_counts(footer_scan(spark, root))
    path = scratch_path(spark, "counts")
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def incomplete_months(
    plan: DataFrame, stored: DataFrame | None, min_rows: int = COMPLETE_MONTH_ROWS, counts: DataFrame | None = None,
) -> DataFrame:
    """Planned months that are missing or too small. `counts` (year, month, n) spares counting `stored`."""
    if stored is None and counts is None:
        return plan.withColumn("n", F.lit(0).cast("long"))
    joined = plan.join(month_counts(stored) if counts is None else counts, PARTITION_COLS, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.where(F.col("n") < min_rows).select("start", "end", *PARTITION_COLS, "n")


def backfill(
    cleaned: DataFrame, stored: DataFrame | None, root: str, first_year: int, last_year: int,
    min_rows: int = COMPLETE_MONTH_ROWS, counts: DataFrame | None = None,
) -> None:
    """Load every incomplete month from the landed rows in one job, replacing it.

    The list of months is settled, and written, before the table changes.
    """
    todo = incomplete_months(month_plan(cleaned.sparkSession, first_year, last_year), stored, min_rows, counts)
    todo = materialise(todo, "months")
    rows = partition_keys(cleaned).join(todo.select(*PARTITION_COLS), PARTITION_COLS, "left_semi")
    replace_months(rows.drop(*PARTITION_COLS), root)


def replace_month(cleaned: DataFrame, root: str, year: int, month: int) -> None:
    """Reload one month; a month without rows is left as it is."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    in_month = (F.col(TS) >= first.cast("timestamp_ntz")) & (F.col(TS) < F.add_months(first, 1).cast("timestamp_ntz"))
    replace_months(cleaned.where(in_month), root)


def ingest_increment(cleaned: DataFrame, root: str, control: str, start: str = "2025-01-01") -> str | None:
    """Add the rows after the high-water mark, then move it to the newest of them.

    The batch is named after the mark it started from: a run that died before
    the mark moved is replaced by its retry. Rows arriving late with an older
    timestamp are not picked up.
    """
    spark = cleaned.sparkSession
    mark = get_watermark(spark, control)
    batch = "after-" + (mark or start).replace(":", "").replace("-", "")
    append_months(newer_than(cleaned, mark, start), root, batch)
    latest = newest_in_batch(spark, root, batch)
    if latest is not None:
        set_watermark(spark, control, latest)
    return latest
