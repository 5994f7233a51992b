"""A versioned store of what one training run leaves for later ones: model, thresholds, station features, lag lookup.

A version is a folder with a Parquet table for each name and, where there is one, the MLlib
model. It is published by its lines in the manifest, one file written last: until then nobody
finds it, so a later run never mixes thresholds of one training with a model of another. Loading checks each
table against the schema in the manifest and against the columns its users need.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stationflow.plans import model as models
from stationflow.plans.forecast import run_forecast
from stationflow.schema import FEATURE_COLS, STATION, STATION_FEATURES
from stationflow.sources.commits import rows_or_none

MANIFEST = "seq long, version string, name string, schema string, rows long"
MODEL = "model"
#: The columns without which a table is of no use.
NEEDED = {
    "thresholds": [STATION, "threshold"],
    "stations": [STATION, *STATION_FEATURES],
    "lookup": [STATION, "dow", "hour", "avg_ridership"],
}


@dataclass(frozen=True)
class Artefacts:
    version: str
    tables: dict[str, DataFrame]
    model: PipelineModel | None


def _need(name: str, columns: list[str]) -> None:
    missing = [c for c in NEEDED.get(name, []) if c not in columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")


def publish(spark: SparkSession, root: str, version: str, tables: dict[str, DataFrame], model: PipelineModel | None = None) -> None:
    """Write `tables` by name and the model as `version`. A published version is not changed any more.

    A run that died before its manifest is repeated under the same version and replaces what it left.
    """
    manifest = rows_or_none(spark, f"{root}/manifest", MANIFEST)
    if manifest.where(F.col("version") == version).limit(1).count():
        raise ValueError(f"version {version} is published")
    seq = manifest.agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
    lines = []
    for name, df in tables.items():
        _need(name, df.columns)
        path = f"{root}/{version}/{name}"
        df.write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        lines.append((seq, version, name, stored.schema.json(), stored.count()))
    if model is not None:
        models.save_model(model, f"{root}/{version}/{MODEL}")
        lines.append((seq, version, MODEL, None, None))
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")  # a line a table


def load(spark: SparkSession, root: str, version: str | None = None) -> Artefacts:
    """The artefacts of `version`, by default of the last one published."""
    manifest = rows_or_none(spark, f"{root}/manifest", MANIFEST)
    lines = (manifest.where(F.col("version") == version) if version else manifest).orderBy("seq").collect()  # a line a table and version
    if not lines:
        raise ValueError(f"no version {version} in {root}" if version else f"nothing published in {root}")
    last = lines[-1].version
    tables, model = {}, None
    for line in (x for x in lines if x.version == last):
        path = f"{root}/{last}/{line.name}"
        if line.name == MODEL:
            model = models.load_model(path)
            continue
        stored = spark.read.parquet(path)
        if stored.schema != StructType.fromJson(json.loads(line.schema)):
            raise ValueError(f"{line.name} of version {last} is not stored as it was published")
        _need(line.name, stored.columns)
        tables[line.name] = stored
    return Artefacts(last, tables, model)


def forecast_from(artefacts: Artefacts, start_date: str, days: int = 90, scorer: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """`run_forecast` with the stored tables and model; `scorer` takes the model's place."""
    if scorer is None:
        if artefacts.model is None:
            raise ValueError(f"version {artefacts.version} has no model")
        scorer = lambda df: models.score(artefacts.model, df, FEATURE_COLS)
    return run_forecast(*(artefacts.tables[t] for t in ("stations", "lookup", "thresholds")), scorer, start_date, days, **options)
