"""Landed pages, partitioned tables, watermarks, streams, models."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators.rollups import hourly_ridership
from stationflow.plans import backfill, model
from stationflow.sources import facts, landed, sinks
from stationflow.streaming import ingest, rollup


def page(path, rows):
    records = [
        {"transit_timestamp": t, "station_complex_id": "1", "station_complex": s, "borough": "Bronx", "payment_method": "card",
         "ridership": str(v), "transfers": "0", "latitude": "40.8", "longitude": "-73.9", "georeference": {"type": "Point", "coordinates": [1, 2]}}
        for s, t, v in rows
    ]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records))


def test_pages_are_cleaned(spark, tmp_path):
    page(tmp_path / "p" / "1.json", [("A", "2024-01-01T05:00:00.000", 3.5), ("A", "2024-01-01T06:00:00", 1)])
    df = landed.clean(landed.read_landed(spark, f"{tmp_path}/p"))
    assert dict(df.dtypes)["transit_timestamp"] == "timestamp_ntz" and dict(df.dtypes)["ridership"] == "double"
    assert "georeference" not in df.columns
    assert sorted((str(r.transit_timestamp), r.ridership) for r in df.collect()) == [("2024-01-01 05:00:00", 3.5), ("2024-01-01 06:00:00", 1.0)]


def test_bad_values_fail_or_are_marked(spark, tmp_path):
    page(tmp_path / "p" / "1.json", [("A", "2024-01-01T05:00:00.000", "many"), ("A", "2024-01-01T06:00:00", 1)])
    raw = landed.read_landed(spark, f"{tmp_path}/p")
    with pytest.raises(Exception, match="bad ridership: many"):
        landed.clean(raw).collect()
    marked = landed.clean(raw, on_error="mark").orderBy("transit_timestamp").collect()
    assert [(r.is_bad, r.ridership) for r in marked] == [(True, None), (False, 1.0)]


@pytest.mark.parametrize("text", ["2024-01", "2024-01-05", "2024-01-05T05:00:00Z", " 2024-01-05T05:00:00", "2024-01-05 05:00:00"])
def test_only_iso_timestamps_pass(spark, tmp_path, text):
    page(tmp_path / "p" / "1.json", [("A", text, 1)])
    raw = landed.read_landed(spark, f"{tmp_path}/p")
    with pytest.raises(Exception, match="bad transit_timestamp"):
        landed.clean(raw).collect()
    (row,) = landed.clean(raw, on_error="mark").collect()
    assert row.is_bad and row.transit_timestamp is None


def rows(spark, *items):
    df = spark.createDataFrame([(n, t, float(v)) for n, t, v in items], "station_complex string, t string, ridership double")
    return df.selectExpr(
        "cast(t as timestamp_ntz) transit_timestamp", "'1' station_complex_id", "station_complex", "'Bronx' borough",
        "'card' payment_method", "ridership", "0D transfers", "40.8D latitude", "-73.9D longitude",
    )


def stored(spark, root):
    return sorted((r.month, r.ridership) for r in facts.read_ridership(spark, root).collect())


def test_only_written_months_are_replaced(spark, tmp_path):
    root = f"{tmp_path}/fact"
    sinks.replace_months(rows(spark, ("A", "2024-01-05T00:00:00", 1), ("A", "2024-02-05T00:00:00", 2)), root)
    sinks.replace_months(rows(spark, ("A", "2024-02-09T00:00:00", 3)), root)
    assert stored(spark, root) == [(1, 1.0), (2, 3.0)]
    backfill.replace_month(rows(spark, ("A", "2024-03-09T00:00:00", 3)), root, 2024, 2)  # no rows for February
    assert stored(spark, root) == [(1, 1.0), (2, 3.0)]
    sinks.append_months(rows(spark, ("A", "2024-02-10T00:00:00", 4)), root)
    assert stored(spark, root) == [(1, 1.0), (2, 3.0), (2, 4.0)]


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    root = f"{tmp_path}/fact"
    for batch, value in (("one", 1), ("two", 2), ("two", 2)):
        sinks.append_months(rows(spark, ("A", "2024-01-05T00:00:00", value)), root, batch)
    assert stored(spark, root) == [(1, 1.0), (1, 2.0)]


def test_watermark_moves_and_a_crashed_run_is_replaced(spark, tmp_path):
    root, control = f"{tmp_path}/fact", f"{tmp_path}/control"
    assert sinks.get_watermark(spark, control) is None
    first = rows(spark, ("A", "2024-12-31T23:00:00", 9), ("A", "2025-01-01T00:00:00", 1), ("A", "2025-01-02T00:00:00", 2))
    assert backfill.ingest_increment(first, root, control) == "2025-01-02T00:00:00"
    more = first.unionByName(rows(spark, ("A", "2025-01-02T00:00:00", 5), ("A", "2025-02-01T00:00:00", 3)))
    # a run that wrote but died before it moved the mark
    sinks.append_months(landed.newer_than(more, "2025-01-02T00:00:00", ""), root, "after-20250102T000000")
    assert backfill.ingest_increment(more, root, control) == "2025-02-01T00:00:00"
    assert backfill.ingest_increment(more, root, control) is None
    assert sinks.get_watermark(spark, control) == "2025-02-01T00:00:00"
    # strictly newer only: the late row at the old mark is not taken in
    assert stored(spark, root) == [(1, 1.0), (1, 2.0), (2, 3.0)]
    sinks.set_watermark(spark, control, "2025-01-15T00:00:00")
    assert sinks.get_watermark(spark, control) == "2025-01-15T00:00:00"


def test_month_plan_and_completeness(spark):
    plan = backfill.month_plan(spark, 2023, 2024)
    got = plan.orderBy("start").collect()
    assert len(got) == 24 and str(got[11].end) == "2024-01-01 00:00:00" and (got[-1].year, got[-1].month) == (2024, 12)
    have = facts.partition_keys(rows(spark, *[("A", f"2023-01-0{d}T00:00:00", 1) for d in range(1, 6)], ("A", "2023-02-01T00:00:00", 1)))
    todo = backfill.incomplete_months(plan, have, min_rows=5)
    assert todo.count() == 23 and {(r.year, r.month): r.n for r in todo.collect()}[(2023, 2)] == 1


def test_range_filter_prunes_partitions(spark, tmp_path, capsys):
    root = f"{tmp_path}/fact"
    sinks.replace_months(rows(spark, *[("A", f"2024-{m:02d}-05T00:00:00", m) for m in range(1, 13)]), root)
    df = facts.select_range(facts.read_ridership(spark, root), "A", "2024-03-01", "2024-06-01")
    assert sorted(r.month for r in df.collect()) == [3, 4, 5]
    capsys.readouterr()
    hourly_ridership(facts.read_ridership(spark, root), "A", "2024-03-01", "2024-06-01").explain("formatted")
    plan = {line.split(":")[0].strip(): line for line in capsys.readouterr().out.splitlines()}
    assert "month" in plan["PartitionFilters"] and "GreaterThanOrEqual(transit_timestamp" in plan["PushedFilters"]
    assert "latitude" not in plan["ReadSchema"]


def test_stream_takes_each_page_once(spark, tmp_path):
    pages, root, check = tmp_path / "pages", f"{tmp_path}/fact", f"{tmp_path}/check"
    run = lambda: ingest.start_ingest(ingest.landed_stream(spark, str(pages)), root, check).awaitTermination()
    sizes = []
    for name in ("1", "2", None, "3"):
        if name:
            page(pages / f"{name}.json", [("A", f"2024-0{name}-01T0{h}:00:00.000", h) for h in range(3)])
        if name != "1":
            run()
            sizes.append(facts.read_ridership(spark, root).count())
    assert sizes == [6, 6, 9]


def test_stream_rollup_equals_batch_for_final_hours(spark, tmp_path):
    source = f"{tmp_path}/source"
    data = rows(spark, *[("A", f"2024-01-01T{h:02d}:30:00", h) for h in range(10)], ("A", "2024-01-01T00:10:00", 5))
    data.write.parquet(source)
    stream = spark.readStream.schema(data.schema).parquet(source)
    hourly = rollup.hourly_stream(stream)
    rollup.start_hourly(hourly, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = {str(r.transit_timestamp)[11:13]: r.ridership for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"00": 5.0, **{f"{h:02d}": float(h) for h in range(1, 7)}}


def test_model_learns_and_survives_saving(spark, tmp_path):
    df = spark.range(400).select(
        (F.col("id") % 24).cast("int").alias("hour"), F.when(F.col("id") % 5 > 0, F.lit(3)).alias("num_lines"),
        (F.col("id") % 24 > 15).cast("int").alias("is_congested"),
    )
    features = ["hour", "num_lines"]
    fitted = model.train_model(df, df, features, rounds=5, depth=3)
    path = f"{tmp_path}/model"
    model.save_model(fitted, path)
    got = model.score(model.load_model(path), df, features)
    assert got.where("predicted != is_congested").count() == 0
    assert got.columns == ["hour", "num_lines", "is_congested", "predicted_prob", "predicted"]
    ranked = model.feature_importance(spark, fitted).collect()
    assert ranked[0].feature == "hour" and len(ranked) == 3
    assert model.class_balance(df).first()["positive_weight"] == pytest.approx(272 / 128)


def boosting_rows(spark, n=300):
    """One input that tells the label in the training rows and nothing in the held ones."""
    x = F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")
    told, random = (x > 9).cast("int"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(2)).cast("int")
    held = F.col("id") % 3 == 0
    return spark.range(n).select(x.alias("hour"), F.when(held, random).otherwise(told).alias("is_congested"), held.alias("held"))


def test_boosting_stops_by_patience_and_keeps_the_best_rounds(spark):
    rows = boosting_rows(spark)
    fitted, rounds = model.train_with_history(rows.where("not held"), rows.where("held"), ["hour"])
    got = rounds.orderBy("round").collect()
    losses = [r.validation_loss for r in got]
    best = min(range(1, len(losses)), key=lambda k: losses[k])
    assert got[0].train_loss == pytest.approx(math.log(2)) == losses[0]
    assert len(got) - 1 == best + model.SETTINGS["patience"] < model.SETTINGS["rounds"]
    assert fitted.stages[-1].getNumTrees == best and [r.round for r in got if r.is_best] == [best]
    scored = model.score(fitted, rows.where("held"), ["hour"]).toPandas()
    p = scored.predicted_prob.where(scored.is_congested == 1, 1 - scored.predicted_prob)
    assert float(-np.log(p).mean()) == pytest.approx(losses[best])


def test_boosting_without_validation_runs_every_round(spark):
    rows = boosting_rows(spark).where("not held")
    fitted, rounds = model.train_with_history(rows, features=["hour"], rounds=12, depth=2)
    losses = [r.train_loss for r in rounds.orderBy("round").collect()]
    assert fitted.stages[-1].getNumTrees == 12 and losses == sorted(losses, reverse=True)
    assert rounds.where("validation_loss is not null").count() == 0
    with pytest.raises(ValueError):
        model.train_model(rows.limit(0), features=["hour"])
