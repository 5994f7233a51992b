"""Landed files and which of them a table has taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.schema import fact_schema
from stationflow.session import materialise
from stationflow.sources.commits import commit_months, newest_mark, read_log, rows_or_none
from stationflow.sources.landed import clean, newer_than, read_landed

FILES = "path string, length long, modificationTime timestamp, commit string"
IDENTITY = ["path", "length", "modificationTime"]


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modificationTime) of every file below `landing`. Lists them without opening one."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).select(*IDENTITY)


def files_taken(spark: SparkSession, root: str) -> DataFrame:
    """The files of all commits that were published. A file that changed afterwards counts as another one."""
    done = read_log(spark, root).select("commit").distinct()
    return rows_or_none(spark, f"{root}/files", FILES).join(done, "commit", "left_semi")


def take_in(
    spark: SparkSession, landing: str, root: str, start: str = "2025-01-01", lines: bool = False, extra: list[str] | None = None,
) -> DataFrame | None:
    """Add the rows of landed files that are not in the table yet; returns those files, or None where there are none.

    Only new files are parsed. Of their rows those after the table's high-water mark are added (on the first run those from
    `start`), as with `newer_than`. Files, rows and mark are one commit: a run that
    died is repeated by the next one with the same name, together with what landed since.
    """
    new = materialise(landed_files(spark, landing).join(files_taken(spark, root), IDENTITY, "left_anti"), "files")
    paths = [r[0] for r in new.select("path").collect()]  # the reader takes its paths from the driver
    if not paths:
        return None
    runs = read_log(spark, root).where(F.col("commit").startswith("landed-")).select("commit").distinct().count()
    commit = f"landed-{runs:06d}"
    listed = new.withColumn("commit", F.lit(commit))
    listed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("commit").parquet(f"{root}/files")
    rows = clean(read_landed(spark, paths, extra, lines))
    commit_months(newer_than(rows, newest_mark(spark, root), start), root, commit, replace=False)
    return new


def taken_schema(extra: list[str] | None = None) -> str:
    """The stored columns of a table filled by `take_in`, for `read_committed`."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fact_schema(extra).fields)
