"""The store of artefacts."""

import pytest
from pyspark.sql import functions as F

from stationflow.plans import artefacts, model
from stationflow.schema import FEATURE_COLS, STATION_FEATURES


def tables(spark, factor=1.0):
    thresholds = spark.createDataFrame([("A", 5.0 * factor)], "station_complex string, threshold double")
    stations = spark.createDataFrame([("A",), ("B",)], "station_complex string").select("station_complex", *[F.lit(1.0 if "ridership" in c else 1).alias(c) for c in STATION_FEATURES])
    cells = spark.range(168).select(F.lit("A").alias("station_complex"), F.floor(F.col("id") / 24).cast("int").alias("dow"), (F.col("id") % 24).cast("int").alias("hour"), (F.col("id") % 24 * factor).alias("avg_ridership"))
    return {"thresholds": thresholds, "stations": stations, "lookup": cells}


def test_versions_are_published_whole_and_loaded_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="nothing published"):
        artefacts.load(spark, root)
    artefacts.publish(spark, root, "one", tables(spark))
    with monkeypatch.context() as patch:  # the second dies after its tables
        patch.setattr(model, "save_model", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            artefacts.publish(spark, root, "two", tables(spark, 2.0), model=object())
    assert artefacts.load(spark, root).version == "one"
    artefacts.publish(spark, root, "two", tables(spark, 2.0))
    last = artefacts.load(spark, root)
    assert last.version == "two" and last.tables["thresholds"].first().threshold == 10.0 and last.model is None
    assert artefacts.load(spark, root, "one").tables["thresholds"].first().threshold == 5.0
    with pytest.raises(ValueError, match="is published"):
        artefacts.publish(spark, root, "two", tables(spark))
    with pytest.raises(ValueError, match="no model"):
        artefacts.forecast_from(last, "2024-02-10", 1)


def test_schemas_are_checked(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="lookup lacks dow"):
        artefacts.publish(spark, root, "bad", {"lookup": tables(spark)["lookup"].drop("dow")})
    artefacts.publish(spark, root, "one", tables(spark))
    changed = tables(spark)["thresholds"].withColumn("threshold", F.col("threshold").cast("int"))
    changed.write.mode("overwrite").parquet(f"{root}/one/thresholds")
    with pytest.raises(ValueError, match="not stored as it was published"):
        artefacts.load(spark, root)


def test_stored_model_forecasts(spark, tmp_path):
    rows = spark.range(200).select(*[(F.col("id") % 24 if c in ("hour", "lag_168") else F.lit(1)).cast("double").alias(c) for c in FEATURE_COLS], (F.col("id") % 24 > 15).cast("int").alias("is_congested"))
    fitted = model.train_model(rows, rounds=3, depth=2)
    artefacts.publish(spark, str(tmp_path), "one", tables(spark), fitted)
    got = artefacts.forecast_from(artefacts.load(spark, str(tmp_path)), "2024-02-10", 2).collect()
    assert {r.station for r in got} == {"A"} and len(got) == 48  # B has no threshold
    late, early = ([r.prob for r in got if (r.hour > 15) == x] for x in (True, False))
    assert min(late) > 0.5 > max(early)
