"""Training, scoring and saving the classifier.

Boosted trees with the published settings (see `boosting`), kept as a Spark MLlib
model. Missing features must be filled for MLlib.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.plans.boosting import boost
from stationflow.schema import FEATURE_COLS, STATION_FEATURES, TARGET_COL
from stationflow.session import materialise

# --- Fixed values: training settings --------------------------------------------
SETTINGS = {"rounds": 500, "depth": 6, "step": 0.05, "row_share": 0.8, "column_share": 0.8, "patience": 20, "seed": 42}
MISSING = -1.0
KNOWN_FLAG = "has_station_features"


def class_balance(df: DataFrame, target: str = TARGET_COL) -> DataFrame:
    """Negatives per positive, the weight that evens the classes out."""
    pos, neg = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives"), F.try_divide(neg, pos).alias("positive_weight"))


def _filled(features: Sequence[str]) -> list[Column]:
    """Model inputs without gaps. Stations unknown to the feature table get -1 in
    its columns and `has_station_features = 0`."""
    known = [c for c in features if c in STATION_FEATURES]
    flag = F.col(known[0]).isNotNull().cast("double") if known else F.lit(1.0)
    return [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in features] + [flag.alias(KNOWN_FLAG)]


def prepare_features(df: DataFrame, features: Sequence[str] = tuple(FEATURE_COLS), target: str = TARGET_COL) -> DataFrame:
    """The target and the model's inputs."""
    return df.select(target, *_filled(features))


def train_model(
    train: DataFrame, validation: DataFrame | None = None, features: Sequence[str] = tuple(FEATURE_COLS),
    target: str = TARGET_COL, **overrides,
) -> PipelineModel:
    """Fit the classifier; with a validation frame boosting stops after 20 rounds without gain and keeps the best round's trees."""
    return train_with_history(train, validation, features, target, **overrides)[0]


def train_with_history(
    train: DataFrame, validation: DataFrame | None = None, features: Sequence[str] = tuple(FEATURE_COLS),
    target: str = TARGET_COL, **overrides,
) -> tuple[PipelineModel, DataFrame]:
    """The fitted classifier, and (round, train_loss, validation_loss, is_best) of every round.

    `overrides` replace SETTINGS. The best round has the least validation loss, the first one of equals; without a validation frame it is the last.
    """
    spark = train.sparkSession
    data = prepare_features(train, features, target).withColumn("held", F.lit(False))
    if validation is not None:
        data = data.unionByName(prepare_features(validation, features, target).withColumn("held", F.lit(True)))
    # Boosting reads its input again in every round: keep the finished features.
    data = materialise(data.where(F.col(target).isNotNull()), "training")
    weight = class_balance(data.where(~F.col("held")), target).first()["positive_weight"] or 1.0
    assembler = VectorAssembler(inputCols=[*features, KNOWN_FLAG], outputCol="features")
    scale = F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("scale")
    rows = assembler.transform(data).select("features", F.col(target).alias("label"), scale, "held")
    booster, rounds = boost(rows, **{**SETTINGS, **overrides})
    told = [(r.number, r.train_loss, r.validation_loss, r.number == booster.getNumTrees) for r in rounds]
    history = spark.createDataFrame(told, "round int, train_loss double, validation_loss double, is_best boolean")
    return PipelineModel([assembler, booster]), history


def score(model: PipelineModel, df: DataFrame, features: Sequence[str] = tuple(FEATURE_COLS)) -> DataFrame:
    """Add `predicted_prob` and `predicted` (cut at 0.5)."""
    scored = model.transform(df.select(F.struct(*df.columns).alias("_given"), *_filled(features)))
    return scored.select(
        "_given.*",
        vector_to_array("probability")[1].alias("predicted_prob"),
        F.col("prediction").cast("int").alias("predicted"),
    )


def feature_importance(spark: SparkSession, model: PipelineModel, top: int | None = None) -> DataFrame:
    """Normalised gain per input, largest first; as long as the list of inputs."""
    assembler, booster = model.stages[0], model.stages[-1]
    rows = [(name, float(v)) for name, v in zip(assembler.getInputCols(), booster.featureImportances.toArray())]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def record_metric(spark: SparkSession, path: str, stage: str, metrics: DataFrame) -> None:
    """Append one stage's AUC row to a progress table."""
    metrics.select(F.lit(stage).alias("stage"), "auc", "n").write.mode("append").parquet(path)
