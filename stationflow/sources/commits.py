"""A month-partitioned table whose changes are commits.

Rows are written to folders `data/year=/month=/version=`, one version a commit. A commit
counts once its lines stand in the log: one line for each month it wrote, with the versions that
hold the month from then on, its rows, and the newest timestamp among them. The log gets one file a commit, so
data, high-water mark and replaced files change together: a run that dies before that file is there has
changed nothing for readers, and its repetition under the same name replaces what it left.

There is one writer at a time. Versions that no month needs any longer stay on disk until `retired` names them to
whoever cleans up; a reader that began before still finds its files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stationflow.functions.timeparts import iso_text
from stationflow.schema import PARTITION_COLS, TS
from stationflow.sources.facts import partition_keys
from stationflow.sources.sinks import balanced

VERSION = "version"
LOG = "seq long, commit string, year int, month int, versions array<string>, rows long, last_timestamp string"


def rows_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; no rows where nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return rows_or_none(spark, f"{root}/log", LOG)


def committed(spark: SparkSession, root: str, commit: str) -> bool:
    return read_log(spark, root).where(F.col("commit") == commit).limit(1).count() > 0


def newest_mark(spark: SparkSession, root: str) -> str | None:
    """The newest timestamp of all commits: the high-water mark."""
    return read_log(spark, root).agg(F.max("last_timestamp")).first()[0]


def live_versions(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, versions) as the last commit of each month left it; a row a month."""
    last = F.row_number().over(Window.partitionBy(*PARTITION_COLS).orderBy(F.desc("seq")))
    known = read_log(spark, root).where("year is not null").withColumn("_last", last)
    return known.where("_last = 1").select(*PARTITION_COLS, "versions")


def read_committed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The table's rows as of now, those of live versions only. `schema` names the stored columns without year and month.

    The live folders (a line a month and version) go into the scan as a filter on partition columns, so other
    versions are not opened, and a later commit does not change this frame.
    """
    live = live_versions(spark, root).select(*PARTITION_COLS, F.explode("versions").alias(VERSION))
    live = live.select(F.concat_ws("/", *PARTITION_COLS, VERSION)).collect()
    stored = rows_or_none(spark, f"{root}/data", f"{schema}, year int, month int, {VERSION} string")
    return stored.where(F.concat_ws("/", *PARTITION_COLS, VERSION).isin([r[0] for r in live])).drop(VERSION)


def month_rows(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, n): rows of each live month as counted when they were written; reads the log only."""
    live = live_versions(spark, root).select(*PARTITION_COLS, F.explode("versions").alias("commit"))
    return read_log(spark, root).join(live, [*PARTITION_COLS, "commit"]).groupBy(*PARTITION_COLS).agg(F.sum("rows").alias("n"))


def commit_months(df: DataFrame, root: str, commit: str, replace: bool = True) -> str | None:
    """Write the months of `df` as commit `commit` and return the newest timestamp among its rows.

    With `replace` a month holds these rows alone from then on, else also those it had. An empty frame makes an
    empty commit. A commit whose name stands in the log already is not done again. Rows without a timestamp have no month and are not part of the table.
    """
    spark = df.sparkSession
    if not committed(spark, root, commit):
        stage(df, root, commit)
        publish(spark, root, commit, replace)
    return read_log(spark, root).where(F.col("commit") == commit).agg(F.max("last_timestamp")).first()[0]


def stage(df: DataFrame, root: str, commit: str) -> None:
    """Write the rows where no reader looks yet. What an attempt of the same name left is replaced month by month."""
    keyed = partition_keys(df).withColumn(VERSION, F.lit(commit))
    writer = balanced(keyed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITION_COLS, VERSION).parquet(f"{root}/data")


def publish(spark: SparkSession, root: str, commit: str, replace: bool) -> None:
    """Add the commit's lines to the log, from the rows that were written: one file."""
    written = rows_or_none(spark, f"{root}/data", f"{TS} timestamp_ntz, year int, month int, {VERSION} string").where(F.col(VERSION) == commit)
    months = written.groupBy(*PARTITION_COLS).agg(F.count("*").alias("rows"), F.max(iso_text(F.col(TS))).alias("last_timestamp"))
    before = live_versions(spark, root).withColumnRenamed("versions", "_before")
    own = F.array(F.lit(commit))
    versions = own if replace else F.concat(F.coalesce("_before", F.array().cast("array<string>")), own)
    seq = read_log(spark, root).agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
    lines = months.join(before, PARTITION_COLS, "left").select(
        F.lit(seq).cast("long").alias("seq"), F.lit(commit).alias("commit"), *PARTITION_COLS, versions.alias("versions"), "rows", "last_timestamp"
    )
    nothing = spark.createDataFrame([(seq, commit, None, None, None, 0, None)], LOG)
    lines.unionByName(nothing).coalesce(1).write.mode("append").parquet(f"{root}/log")  # a line a month


def compact_months(spark: SparkSession, root: str, schema: str, commit: str, most_versions: int = 1) -> None:
    """Write each month with more than `most_versions` live versions anew as one, in one commit.

    The rows stay the same; files are as large as the session's advisory partition size. Readers see the old files or the new ones.
    """
    many = live_versions(spark, root).where(F.size("versions") > most_versions).select(*PARTITION_COLS)
    rows = read_committed(spark, root, schema).join(many, PARTITION_COLS, "left_semi").drop(*PARTITION_COLS)
    commit_months(rows, root, commit)


def retired(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, version) folders that hold no live rows: replaced ones, and those of attempts that were never published."""
    stored = rows_or_none(spark, f"{root}/data", f"{TS} timestamp_ntz, year int, month int, {VERSION} string").select(*PARTITION_COLS, VERSION).distinct()
    live = live_versions(spark, root).select(*PARTITION_COLS, F.explode("versions").alias(VERSION))
    return stored.join(live, [*PARTITION_COLS, VERSION], "left_anti")
