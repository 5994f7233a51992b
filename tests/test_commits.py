"""Commits of months, compaction, taking in landed files, counts from footers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stationflow.operators.features import add_lag_features, continue_lag_features
from stationflow.plans import backfill
from stationflow.session import materialise
from stationflow.sources import commits, intake, sinks
from stationflow.streaming import rollup

SCHEMA = "transit_timestamp timestamp_ntz, station_complex string, ridership double"


def rows(spark, *values):
    text = spark.createDataFrame([(t, s, float(v)) for t, s, v in values], "t string, station_complex string, ridership double")
    return text.selectExpr("cast(t as timestamp_ntz) as transit_timestamp", "station_complex", "ridership")


def held(spark, root):
    return sorted((str(r.transit_timestamp)[:10], r.ridership) for r in commits.read_committed(spark, root, SCHEMA).collect())


JAN, FEB, MAR = ("2024-01-05T00:00:00", "A", 1), ("2024-02-05T00:00:00", "A", 2), ("2024-03-05T00:00:00", "A", 3)


def test_commit_replaces_months_and_moves_the_mark(spark, tmp_path):
    root = str(tmp_path)
    assert commits.newest_mark(spark, root) is None and held(spark, root) == []
    assert commits.commit_months(rows(spark, JAN, FEB), root, "one") == "2024-02-05T00:00:00"
    commits.commit_months(rows(spark, ("2024-01-06T00:00:00", "A", 9)), root, "two")
    assert held(spark, root) == [("2024-01-06", 9.0), ("2024-02-05", 2.0)]
    assert commits.newest_mark(spark, root) == "2024-02-05T00:00:00"
    assert [tuple(r) for r in commits.retired(spark, root).collect()] == [(2024, 1, "one")]
    # A name that is in the log is not written again, and an empty frame changes no month.
    commits.commit_months(rows(spark, MAR), root, "two")
    commits.commit_months(rows(spark, MAR).where("false"), root, "none")
    assert held(spark, root) == [("2024-01-06", 9.0), ("2024-02-05", 2.0)]


def test_write_that_dies_before_the_log_changes_nothing_and_resumes(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commits.commit_months(rows(spark, JAN), root, "one")
    before = commits.read_committed(spark, root, SCHEMA)

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", die)
        with pytest.raises(RuntimeError):
            commits.commit_months(rows(spark, FEB, ("2024-01-07T00:00:00", "A", 7)), root, "two", replace=False)
    assert held(spark, root) == [("2024-01-05", 1.0)] and commits.newest_mark(spark, root) == "2024-01-05T00:00:00"
    mark = commits.commit_months(rows(spark, FEB, ("2024-01-07T00:00:00", "A", 7)), root, "two", replace=False)
    assert mark == commits.newest_mark(spark, root) == "2024-02-05T00:00:00"
    assert held(spark, root) == [("2024-01-05", 1.0), ("2024-01-07", 7.0), ("2024-02-05", 2.0)]
    assert [r.ridership for r in before.collect()] == [1.0]  # an open reader keeps what it saw


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    root = str(tmp_path)
    for k in range(5):
        commits.commit_months(rows(spark, (f"2024-01-0{k + 1}T00:00:00", "A", k)), root, f"b{k}", replace=False)
    commits.commit_months(rows(spark, FEB), root, "feb")
    old = commits.read_committed(spark, root, SCHEMA)
    opened = lambda df: df.select(F.input_file_name()).distinct().count()
    wanted, files = held(spark, root), opened(old)
    commits.compact_months(spark, root, SCHEMA, "compact")
    new = commits.read_committed(spark, root, SCHEMA)
    assert held(spark, root) == wanted and files == 6 and opened(new) == 2
    assert sorted(r.ridership for r in old.collect()) == sorted(r.ridership for r in new.collect())
    assert {(r.month, r.n) for r in commits.month_rows(spark, root).collect()} == {(1, 5), (2, 1)}
    assert commits.retired(spark, root).count() == 5
    for part in tmp_path.glob("data/year=2024/month=1/version=b*/*.parquet"):
        part.write_bytes(b"gone")
    assert held(spark, root) == wanted  # files of other versions are not opened
    assert commits.newest_mark(spark, root) == "2024-02-05T00:00:00"


# --- landed files ----------------------------------------------------------------------------
def land(path, *values):
    record = lambda t, s, v: {"transit_timestamp": t + ".000", "station_complex": s, "ridership": str(v)}
    with open(path, "w") as f:
        f.write("".join(json.dumps(record(*v)) + "\n" for v in values))


def spoil(path):
    """Make a file unreadable without changing its size or time."""
    before = os.stat(path)
    with open(path, "w") as f:
        f.write("x" * before.st_size)
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))


def taken(spark, root):
    return sorted((str(r.transit_timestamp)[:10], r.ridership) for r in commits.read_committed(spark, root, intake.taken_schema()).collect())


def test_second_run_opens_new_files_only(spark, tmp_path):
    pages, root = tmp_path / "pages", str(tmp_path / "table")
    pages.mkdir()
    land(pages / "a.json", JAN)
    assert intake.take_in(spark, str(pages), root, "2024-01-01", lines=True).count() == 1
    spoil(pages / "a.json")
    (pages / "more").mkdir()
    land(pages / "more" / "b.json", FEB, ("2023-12-31T00:00:00", "A", 8))  # before the mark: left out
    new = intake.take_in(spark, str(pages), root, "2024-01-01", lines=True)
    assert [r.path.rsplit("/", 1)[1] for r in new.collect()] == ["b.json"]
    assert taken(spark, root) == [("2024-01-05", 1.0), ("2024-02-05", 2.0)]
    spoil(pages / "more" / "b.json")
    assert intake.take_in(spark, str(pages), root, lines=True) is None
    assert taken(spark, root) == [("2024-01-05", 1.0), ("2024-02-05", 2.0)] and commits.newest_mark(spark, root) == "2024-02-05T00:00:00"


def test_run_that_died_is_repeated_with_its_files(spark, tmp_path, monkeypatch):
    pages, root = tmp_path / "pages", str(tmp_path / "table")
    pages.mkdir()
    land(pages / "a.json", JAN)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            intake.take_in(spark, str(pages), root, "2024-01-01", lines=True)
    assert taken(spark, root) == [] and intake.files_taken(spark, root).count() == 0
    land(pages / "b.json", FEB)
    assert intake.take_in(spark, str(pages), root, "2024-01-01", lines=True).count() == 2
    assert taken(spark, root) == [("2024-01-05", 1.0), ("2024-02-05", 2.0)]


# --- counts ------------------------------------------------------------------------------------
def test_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path)
    sinks.replace_months(rows(spark, JAN, JAN, FEB), root)
    counts = backfill.month_counts_from_footers(spark, root)
    assert {(r.year, r.month, r.n) for r in counts.collect()} == {(2024, 1, 2), (2024, 2, 1)}
    plan = backfill.month_counts(backfill.footer_scan(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [year, month]" in plan
    missing = backfill.incomplete_months(backfill.month_plan(spark, 2024, 2024), None, 2, counts)
    assert sorted(r.month for r in missing.collect()) == list(range(2, 13))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


# --- layout ------------------------------------------------------------------------------------
def scanned(df):
    """Rows that leave the Parquet scan: those of the row groups it could not pass over."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_station_layout_passes_over_other_stations(spark, tmp_path):
    n = 40_000
    stamp = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, cast(id % 2600000 as int))")
    df = spark.range(n).select(stamp.alias("transit_timestamp"), F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(50))).alias("station_complex"), F.lit(1.0).alias("ridership"))
    found = {}
    for layout in (False, True):
        root = f"{tmp_path}/{layout}"
        # small row groups, as months have many at full size
        spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
        try:
            sinks.replace_months(df, root, station_layout=layout)
        finally:
            spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        stored = spark.read.schema(f"{SCHEMA}, year int, month int").parquet(root)
        one = stored.where("station_complex = 'S7'")
        found[layout] = (one.count(), scanned(one))
    assert found[True][0] == found[False][0] > 500
    assert found[True][1] < n / 5 < found[False][1]


# --- streams and carried lags ------------------------------------------------------------------
def test_upserted_hours_count_late_records_and_repeated_batches_once(spark, tmp_path):
    source, root, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "table", "check"))
    batches = [[JAN, FEB], [("2024-01-05T00:40:00", "A", 10), ("2024-01-05T00:00:00", "B", 5)], [("2023-06-01T00:00:00", "A", 7)]]
    for k, batch in enumerate(batches):
        rows(spark, *batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        rollup.start_hourly_upserts(stream, root, checkpoint).awaitTermination()
        if k == 1:  # the stream forgets that the batch was done, and repeats it
            os.remove(f"{checkpoint}/commits/1")
            crc = f"{checkpoint}/commits/.1.crc"
            if os.path.exists(crc):
                os.remove(crc)
            rollup.start_hourly_upserts(stream, root, checkpoint).awaitTermination()
    got = sorted((str(r.transit_timestamp)[:13], r.station_complex, r.ridership) for r in rollup.hourly_table(stream, root).collect())
    assert got == [("2023-06-01 00", "A", 7.0), ("2024-01-05 00", "A", 11.0), ("2024-01-05 00", "B", 5.0), ("2024-02-05 00", "A", 2.0)]


def test_carried_rows_give_the_lags_of_the_whole_history(spark):
    values = [(f"2024-01-{1 + k // 4:02d}T{k % 4:02d}:00:00", s, (k * 7) % 11) for s in "AB" for k in range(60) if s == "A" or k % 3]
    whole = rows(spark, *values)
    brief = dict(lags=(1, 5), mean_windows=(4,), std_windows=(3,), chunk_rows=10)
    plain = {(r.station_complex, r.transit_timestamp): r for r in add_lag_features(whole, **brief).collect()}
    carried, seen = None, {}
    for first, last in ((1, 1), (2, 6), (7, 7), (8, 15)):
        part = whole.where(F.dayofmonth("transit_timestamp").between(first, last) & ((F.col("station_complex") == "A") | (F.lit(first) != 7)))
        made, carried = continue_lag_features(part, carried, **brief)
        carried = materialise(carried, "carried")
        assert carried.groupBy("station_complex").count().agg(F.max("count")).first()[0] <= 5
        seen |= {(r.station_complex, r.transit_timestamp): r for r in made.collect()}
    missing = {k for k in plain if k[0] == "B" and k[1].day == 7}
    assert set(seen) == set(plain) - missing
    for key, r in seen.items():
        if key[0] == "A":
            assert r == plain[key]
