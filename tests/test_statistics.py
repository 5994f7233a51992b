"""Quantiles, ranking metrics and reports against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import evaluate
from stationflow.operators.quantiles import exact_quantiles
from stationflow.operators.rollups import ridership_by_borough, ridership_by_hour
from stationflow.operators.stations import add_station_tier
from stationflow.sources.landed import select_page


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, many repeated and many distinct values, a NULL."""
    return (
        spark.range(60_000)
        .select(
            F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pow(F.rand(5), 4) * 1000).alias("x"),
        )
        .withColumn("x", F.when(F.rand(6) > 0.01, F.col("x")))
        .cache()
    )


PROBS = [0.0, 0.25, 0.5, 0.8, 0.95, 1.0]


@pytest.mark.parametrize("open_rows, margin", [(0, 0.001), (0, 1e-7), (10_000, 0.001)])
def test_quantiles_are_exact_and_bit_equal_for_any_bracket(skewed, open_rows, margin):
    """The narrowest brackets miss most ranks, which are then found with wider ones."""
    names = [f"q{i}" for i in range(len(PROBS))]
    got = exact_quantiles(skewed, ["k"], "x", PROBS, names, open_rows, margin).toPandas().set_index("k").sort_index()
    for key, part in skewed.toPandas().groupby("k"):
        np.testing.assert_allclose(got.loc[key, names].astype(float), np.quantile(part["x"].dropna(), PROBS), rtol=1e-12)
    open_ones = exact_quantiles(skewed, ["k"], "x", PROBS, names, 10**9).toPandas().set_index("k").sort_index()
    assert got.equals(open_ones)


@pytest.mark.parametrize("margin", [0.001, 1e-7])
def test_quantiles_without_keys(skewed, margin):
    got = exact_quantiles(skewed, [], "x", [0.8], ["q"], 0, margin).first()["q"]
    assert got == pytest.approx(np.quantile(skewed.toPandas()["x"].dropna(), 0.8), rel=1e-12)


def test_not_a_number_is_the_largest(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "x double")
    got = exact_quantiles(df, [], "x", [0.5, 0.9], ["half", "top"]).first()
    assert got.half == 2.0 and np.isnan(got.top)


def test_quantile_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "k string, x double")
    assert [tuple(r) for r in exact_quantiles(df, ["k"], "x", [0.8], ["q"]).collect()] == [("a", 5.0)]


def test_tiers_are_interpolated_quartiles(spark):
    values = [1, 2, 3, 4, 5, 6, 7.5, 9, 30, 31]
    df = spark.createDataFrame([(float(v),) for v in values], "avg_ridership double")
    got = [r.station_tier for r in add_station_tier(df).orderBy("avg_ridership").collect()]
    assert got == [1, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def test_equal_tier_edges_are_refused(spark):
    df = spark.createDataFrame([(1.0,)] * 6, "avg_ridership double")
    with pytest.raises(Exception, match="unique"):
        add_station_tier(df).collect()


def scored(spark, groups=3, n=400, seed=1, digits=2):
    rng = np.random.default_rng(seed)
    p = np.round(rng.beta(0.4, 0.8, n), digits)
    y = (rng.random(n) < p).astype(int)
    g = rng.integers(0, groups, n)
    rows = [(int(a), float(b), int(c), int(b >= 0.5)) for a, b, c in zip(g, p, y)]
    return spark.createDataFrame(rows, "g int, predicted_prob double, actual int, predicted int"), g, p, y


def pairwise(p, y):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_auc_equals_pair_counting(spark, digits):
    df, g, p, y = scored(spark, digits=digits)
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(pairwise(p, y), abs=1e-12)
    got = {r.g: r.auc for r in evaluate.roc_auc(df, ["g"]).collect()}
    assert got == {k: pytest.approx(pairwise(p[g == k], y[g == k]), abs=1e-12) for k in range(3)}
    flipped = df.withColumn("predicted_prob", 1 - F.col("predicted_prob"))
    assert evaluate.roc_auc(flipped).first()["auc"] == pytest.approx(1 - pairwise(p, y), abs=1e-9)


def test_auc_leaves_out_small_and_one_class_groups(spark):
    rows = [(0, 0.2, 0), (0, 0.4, 1), (1, 0.3, 1), (1, 0.6, 1), (2, 0.1, 0), (2, 0.2, 1), (2, 0.9, 1)]
    df = spark.createDataFrame(rows, "g int, predicted_prob double, actual int")
    assert {r.g for r in evaluate.roc_auc(df, ["g"]).collect()} == {0, 2}
    assert {r.g for r in evaluate.roc_auc(df, ["g"], min_rows=3).collect()} == {2}


def brute_curve(p, y, drop):
    cuts = np.sort(np.unique(p))[::-1]
    tp = np.array([(y[p >= c] == 1).sum() for c in cuts])
    fp = np.array([(y[p >= c] == 0).sum() for c in cuts])
    keep = np.ones(len(cuts), bool)
    if drop:
        keep[1:-1] = (np.diff(tp, 2) != 0) | (np.diff(fp, 2) != 0)
    return [(np.inf, 0.0, 0.0)] + [(c, f / fp[-1], t / tp[-1]) for c, f, t, k in zip(cuts, fp, tp, keep) if k]


@pytest.mark.parametrize("drop", [True, False])
def test_roc_points(spark, drop):
    df, _, p, y = scored(spark, n=150)
    got = sorted((tuple(r) for r in evaluate.roc_points(df, drop_intermediate=drop).collect()), reverse=True)
    np.testing.assert_allclose(got, brute_curve(p, y, drop), atol=1e-12)


def test_roc_keeps_the_highest_score(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 1), (0.2, 0)], "predicted_prob double, actual int")
    got = sorted((tuple(r) for r in evaluate.roc_points(df).collect()), reverse=True)
    assert [r[0] for r in got] == [np.inf, 0.9, 0.7, 0.2]


def test_calibration_bins_are_right_closed(spark):
    rows = [(0.0, 0), (0.1, 1), (0.10001, 0), (0.3, 1), (0.95, 1), (1.0, 0)]
    df = spark.createDataFrame(rows, "predicted_prob double, actual int")
    got = {r.bin: (r.n, r.fraction_positive) for r in evaluate.calibration_curve(df).collect()}
    assert got == {0: (2, 0.5), 1: (1, 0.0), 2: (1, 1.0), 9: (2, 0.5)}


def test_histogram_counts_every_row_in_its_class(spark):
    df, _, p, y = scored(spark, digits=5)
    got = evaluate.score_histogram(df).toPandas()
    for label in (0, 1):
        want, edges = np.histogram(p[y == label], bins=50)
        mine = got[got.actual == label].sort_values("bin")
        np.testing.assert_array_equal(mine["n"], want)
        np.testing.assert_allclose(mine["left_edge"], edges[:-1])


def test_report_matches_hand_counts(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    df = spark.createDataFrame(rows, "actual int, predicted int")
    got = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert got["1"].precision == pytest.approx(6 / 9) and got["1"].recall == pytest.approx(6 / 8)
    assert got["0"].precision == pytest.approx(9 / 11) and got["0"].support == 12
    assert got["accuracy"].f1_score == pytest.approx(15 / 20) and got["weighted avg"].support == 20
    assert got["weighted avg"].recall == pytest.approx(15 / 20)
    none = evaluate.classification_report(df.where("predicted = 0"))
    assert {r.label: r.precision for r in none.collect()}["1"] == 0.0


def test_chronological_split_is_by_position(spark, hours):
    rows = [("A", f"2024-01-{d:02d}T0{h}:00:00", 1.0) for d in range(1, 6) for h in range(3)]
    got = evaluate.chronological_split(hours(rows), 0.8).orderBy("transit_timestamp").collect()
    assert [r.is_train for r in got] == [1] * 12 + [0] * 3


def test_hourly_pattern_rescales_and_takes_first_peak(spark, hours):
    rows = [(n, f"2024-01-01T{h:02d}:00:00", float(v)) for n in "AB" for h, v in enumerate([0, 10, 10, 5])]
    df = hours(rows).withColumn("predicted_prob", F.col("ridership") / 100)
    got = evaluate.hourly_pattern(df).collect()
    assert [r.is_actual_peak for r in got] == [0, 1, 0, 0] == [r.is_predicted_peak for r in got]
    assert [r.predicted_scaled for r in got] == pytest.approx([r.actual for r in got])


def test_drift_keeps_the_strongest(spark):
    rows = [(f"s{i}", (i - 5) / 50) for i in range(11)]
    df = spark.createDataFrame(rows, "station_complex string, drift double")
    got = [r.station_complex for r in evaluate.largest_drifts(df, k=2).collect()]
    assert got == ["s0", "s1", "s9", "s10"]


def test_average_per_record_is_not_average_per_hour(spark):
    rows = [("A", "2024-01-01T00:00:00", v) for v in (1.0, 2.0, 6.0)]
    df = spark.createDataFrame(rows, "station_complex string, t string, ridership double")
    got = ridership_by_hour(df.selectExpr("cast(t as timestamp_ntz) transit_timestamp", "station_complex", "ridership")).first()
    assert (got.avg_ridership, got.total_ridership) == (3.0, 9.0)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.75, 1.0])
def test_chronological_split_cuts_inside_one_timestamp(spark, hours, fraction):
    rows = [(f"s{i % 4}", f"2024-01-01 0{i // 4}:00:00", float(i)) for i in range(12)]
    got = evaluate.chronological_split(hours(rows), fraction).orderBy("transit_timestamp", "station_complex").collect()
    assert [r.is_train for r in got] == [int(i < int(fraction * 12)) for i in range(12)]


def test_chronological_split_of_no_rows(hours):
    assert evaluate.chronological_split(hours([]).limit(0), 0.8).collect() == []


def test_margins_beyond_0_and_1_rank_like_any_score(spark):
    rng = np.random.default_rng(3)
    margin, y = rng.normal(0, 4, 300).round(1), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(margin, y)], "predicted_prob double, actual int")
    pos, neg = margin[y == 1][:, None], margin[y == 0][None, :]
    want = ((pos > neg) + (pos == neg) / 2).mean()
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("offset, limit", [(0, 3), (3, 4), (10, 5), (12, 5), (0, 50)])
def test_page_holds_the_rows_at_its_positions(spark, hours, offset, limit):
    rows = [(f"s{i % 4}", f"2024-01-01 0{i // 4}:00:00", float(i)) for i in range(12)]
    page = select_page(hours(rows), limit=limit, offset=offset)
    assert [r.ridership for r in page.collect()] == [float(i) for i in range(12)][offset : offset + limit]


def test_rollups_by_hour_and_borough_keep_to_their_range(spark):
    rows = [("1996-01-01 05:00:00", "a", "X", 1.0), ("1996-01-02 05:00:00", "a", "X", 2.0), ("1996-01-02 06:00:00", "b", "Y", 4.0), ("1996-01-03 05:00:00", "b", "X", 8.0)]
    df = spark.createDataFrame(rows, "t string, station_complex string, borough string, ridership double").selectExpr("cast(t as timestamp_ntz) transit_timestamp", "station_complex", "borough", "ridership")
    df = df.withColumn("year", F.year("transit_timestamp")).withColumn("month", F.month("transit_timestamp"))
    hours = {r.hour_of_day: r.total_ridership for r in ridership_by_hour(df, start="1996-01-02", end="1996-01-03").collect()}
    assert hours == {5: 2.0, 6: 4.0}
    boroughs = {r.borough: r.total_ridership for r in ridership_by_borough(df, start="1996-01-02").collect()}
    assert boroughs == {"X": 10.0, "Y": 4.0}
