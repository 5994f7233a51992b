"""Session helpers: settings the library relies on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, name: str = "stationflow") -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Taken from `spark.checkpoint.dir`; only where that is unset (tests on one
    machine) a temporary folder is made and remembered in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("stationflow.scratch", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="stationflow-")
        spark.conf.set("stationflow.scratch", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where one intermediate result feeds several branches: the work before
    it runs once, a lost executor costs a re-read rather than a recomputation,
    and the file sizes let Catalyst decide on broadcasts from real numbers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
