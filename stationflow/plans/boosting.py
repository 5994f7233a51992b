"""Gradient boosting judged round by round on a validation frame.

Each round fits one MLlib regression tree to the Newton step of the logistic loss
(target gradient / curvature, weight curvature), so a split's gain and a leaf's value are
those of second-order boosting. After the round the losses of both frames are measured in one pass. Boosting stops
when the validation loss has not improved for `patience` rounds, and the trees up to the
best round are kept as one MLlib model.

The margins of a round are kept with `persist` and written to the shared folder every
CUT rounds: a lost executor repeats at most CUT trees' predictions, and plans stay short.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.session import materialise

CUT = 10
#: The least curvature of a row and weight of a leaf.
LEAST_CURVATURE, LEAF_WEIGHT = 1e-16, 1.0


@dataclass(frozen=True)
class Round:
    """Mean log losses after a round; round 0 is the start, where every probability is one half."""

    number: int
    train_loss: float
    validation_loss: float | None


def _probability(margin: str) -> Column:
    return 1.0 / (1.0 + F.exp(-F.col(margin)))


def log_loss(label: Column, probability: Column) -> Column:
    """A row's log loss, with its probability kept off 0 and 1 by 1e-15."""
    p = F.least(F.greatest(probability, F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.when(label == 1, F.log(p)).otherwise(F.log(1 - p))


def _measure(state: DataFrame, number: int) -> tuple[Round, float]:
    """The round's losses and the curvature that the next tree shares out."""
    p = _probability("margin")
    loss = log_loss(F.col("label"), p)
    weight = F.sum(F.when(~F.col("held"), F.col("scale") * p * (1 - p)))
    train, validation, mass = state.agg(F.avg(F.when(~F.col("held"), loss)), F.avg(F.when(F.col("held"), loss)), weight).first()
    return Round(number, train, validation), mass or 0.0


def boost(
    data: DataFrame, rounds: int = 500, depth: int = 6, step: float = 0.05, row_share: float = 0.8, column_share: float = 0.8,
    patience: int | None = 20, seed: int = 42, bins: int = 64, leaf_weight: float = LEAF_WEIGHT, features: str = "features",
) -> tuple[GBTClassificationModel, list[Round]]:
    """Fit on `data`: (`features` vector, label 0/1, scale > 0, held).

    Rows with `held` are the validation frame: no tree sees them, they judge only. Without any, or with
    `patience` None, all `rounds` are run. `scale` weighs a training row; losses are plain means. A leaf
    has at least `leaf_weight` of weighted curvature. Returns the model of the best round's trees and
    the rounds one by one, from round 0.
    """
    state = data.select(features, F.col("label").cast("double").alias("label"), F.col("scale").cast("double").alias("scale"), "held", F.lit(0.0).alias("margin"))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    start, mass = _measure(state, 0)
    history, trees = [start], []
    judged = start.validation_loss is not None
    if start.train_loss is None:
        raise ValueError("no training rows")
    best = 0
    while len(trees) < rounds and not (judged and patience is not None and len(trees) - best >= patience):
        p = _probability("margin")
        curvature = F.greatest(p * (1 - p), F.lit(LEAST_CURVATURE))
        steps = state.filter(~F.col("held")).select(features, ((F.col("label") - p) / curvature).alias("step"), (F.col("scale") * curvature).alias("weight"))
        forest = RandomForestRegressor(
            featuresCol=features, labelCol="step", weightCol="weight", numTrees=1, bootstrap=False, subsamplingRate=row_share, featureSubsetStrategy=str(column_share),
            maxDepth=depth, maxBins=bins, minWeightFractionPerNode=min(0.49, leaf_weight / max(mass, 1e-9)), cacheNodeIds=True, seed=seed + len(trees),
        )
        tree = forest.fit(steps).trees[0]
        trees.append(tree)
        moved = tree.setFeaturesCol(features).setPredictionCol("_move").transform(state)
        moved = moved.select(features, "label", "scale", "held", (F.col("margin") + step * F.col("_move")).alias("margin"))
        moved = materialise(moved, "margins") if len(trees) % CUT == 0 else moved
        moved.persist(StorageLevel.MEMORY_AND_DISK)
        now, mass = _measure(moved, len(trees))
        state.unpersist()
        state = moved
        history.append(now)
        if judged and (best == 0 or now.validation_loss < history[best].validation_loss):
            best = len(trees)
    state.unpersist()
    return assembled(trees[: best if judged else None], step), history


def assembled(trees: list, step: float) -> GBTClassificationModel:
    """One MLlib model of the trees. MLlib's probability doubles the margin, so each tree has half the step."""
    if not trees:
        raise ValueError("no tree")
    first, gateway = trees[0]._java_obj, SparkContext._active_spark_context._gateway
    array = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for k, tree in enumerate(trees):
        array[k], weights[k] = tree._java_obj, step / 2
    uid = gateway.jvm.org.apache.spark.ml.util.Identifiable.randomUID("gbtc")
    return GBTClassificationModel(gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, array, weights, first.numFeatures(), 2))
