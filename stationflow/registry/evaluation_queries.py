"""Registered queries: splits, rates, drift, metrics.

The score is a function SQL can say too, so every metric has a comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import evaluate
from stationflow.operators.labels import add_congestion_label
from stationflow.operators.rollups import hour_weekday_matrix
from stationflow.operators.stations import build_station_features
from stationflow.plans import model, training
from stationflow.plans.training import scored
from stationflow.registry.adapters import DD, HH, orders_view
from stationflow.registry.base import query, rounded, rounds
from stationflow.registry.feature_queries import (
    LIMITS, MONTHLY, calendar_sql, congestion_label, events_table, holiday_sql, label_sql, labels, lag_sql, orders_table,
)
from stationflow.session import materialise, scratch_path


def ratio_score(scale: float):
    """A stand-in model: rises with ridership, stays below 1."""
    return lambda df: df.withColumn("predicted_prob", F.col("ridership") / (F.col("ridership") + scale))


def scored_events(spark, sf_dir):
    return scored(congestion_label(spark, sf_dir), ratio_score(50.0))


def scored_orders(spark, sf_dir):
    return scored(add_congestion_label(orders_table(spark, sf_dir)), ratio_score(200_000.0))


def _scored_sql(source: str, scale: int) -> str:
    return f"""{LIMITS.format(source=source, where="TRUE")}, lab AS ({label_sql(source)}),
    s AS (SELECT *, ridership / (ridership + {scale}) AS predicted_prob,
      CAST(ridership / (ridership + {scale}) >= 0.5 AS INTEGER) AS predicted, is_congested AS actual FROM lab)"""


S = f"{HH}, {_scored_sql('hh', 50)}"
SD = f"{DD}, {_scored_sql('dd', 200000)}"


# --- splits and rates ---------------------------------------------------------------------
@query(
    "chrono_split",
    f"""WITH {HH}, x AS (SELECT *, row_number() OVER (ORDER BY transit_timestamp, station_complex) AS rn, COUNT(*) OVER () AS n FROM hh)
    SELECT transit_timestamp, station_complex, ridership, CAST(rn <= floor(0.8 * n) AS INTEGER) AS is_train FROM x""",
)
def chrono_split(spark, sf_dir):
    return evaluate.chronological_split(events_table(spark, sf_dir))


@query("congestion_rate", f"WITH {S} SELECT round(AVG(is_congested), 6) AS congestion_rate, COUNT(*) AS n FROM s")
def congestion_rate(spark, sf_dir):
    return rounded(evaluate.congestion_rate(congestion_label(spark, sf_dir)), ["congestion_rate"])


@query(
    "congestion_rate_by_station",
    f"WITH {S} SELECT station_complex, round(AVG(is_congested), 6) AS congestion_rate, COUNT(*) AS n FROM s GROUP BY 1",
)
def congestion_rate_by_station(spark, sf_dir):
    df = evaluate.congestion_rate(congestion_label(spark, sf_dir), ["station_complex"])
    return rounded(df, ["congestion_rate"])


DRIFT = f"""WITH {DD}, {LIMITS.format(source='dd', where="year(transit_timestamp) = 1999")},
  l1 AS ({label_sql('dd', where="year(transit_timestamp) = 1999")}), l2 AS ({label_sql('dd', where="year(transit_timestamp) = 2000")}),
  r1 AS (SELECT station_complex, AVG(is_congested) AS train_rate FROM l1 GROUP BY 1),
  r2 AS (SELECT station_complex, AVG(is_congested) AS test_rate FROM l2 GROUP BY 1),
  drift AS (SELECT station_complex, train_rate, test_rate, test_rate - train_rate AS drift FROM r1 JOIN r2 USING (station_complex))"""
RATES = ["train_rate", "test_rate", "drift"]


def orders_drift(spark, sf_dir):
    train, test = evaluate.year_split(orders_table(spark, sf_dir), 1999, 2000)
    limits = materialise(labels.congestion_thresholds(train), "thresholds")
    return evaluate.congestion_drift(*[add_congestion_label(df, thresholds=limits) for df in (train, test)])


@query("temporal_split_drift", f"{DRIFT} SELECT station_complex, {rounds(RATES)} FROM drift")
def temporal_split_drift(spark, sf_dir):
    return rounded(orders_drift(spark, sf_dir), RATES)


@query(
    "drift_top_bottom",
    f"""{DRIFT}, up AS (SELECT * FROM drift WHERE drift > 0.02 ORDER BY drift DESC, station_complex LIMIT 20),
    down AS (SELECT * FROM drift WHERE drift < -0.02 ORDER BY drift, station_complex LIMIT 20)
    SELECT station_complex, {rounds(RATES)} FROM (SELECT * FROM up UNION ALL SELECT * FROM down)""",
)
def drift_top_bottom(spark, sf_dir):
    return rounded(evaluate.largest_drifts(orders_drift(spark, sf_dir)), RATES)


@query(
    "rate_heatmap",
    f"WITH {S} SELECT CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week, "
    + ", ".join(f"round(AVG(is_congested) FILTER (hour(transit_timestamp) = {h}), 6) AS h{h:02d}" for h in range(24))
    + " FROM s GROUP BY 1",
)
def rate_heatmap(spark, sf_dir):
    grid = hour_weekday_matrix(congestion_label(spark, sf_dir), "is_congested")
    return rounded(grid, [f"h{h:02d}" for h in range(24)])


# --- metrics ------------------------------------------------------------------------------
@query("confusion_matrix", f"WITH {S} SELECT actual, predicted, COUNT(*) AS n FROM s GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scored_events(spark, sf_dir))


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / ({whole}) ELSE 0 END"


PRF = ["precision", "recall", "f1_score"]


@query(
    "classification_report",
    f"""WITH {S}, c AS (SELECT COUNT(*) FILTER (actual = 1 AND predicted = 1) AS tp, COUNT(*) FILTER (actual = 0 AND predicted = 1) AS fp,
      COUNT(*) FILTER (actual = 1 AND predicted = 0) AS fn, COUNT(*) FILTER (actual = 0 AND predicted = 0) AS tn FROM s),
    k AS (SELECT '0' AS label, {ratio('tn', 'tn + fn')} AS precision, {ratio('tn', 'tn + fp')} AS recall,
        {ratio('2 * tn', '2 * tn + fn + fp')} AS f1_score, tn + fp AS support FROM c
      UNION ALL SELECT '1', {ratio('tp', 'tp + fp')}, {ratio('tp', 'tp + fn')}, {ratio('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM c),
    r AS (SELECT * FROM k
      UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
      UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), SUM(support) FROM k
      UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
        SUM(f1_score * support) / SUM(support), SUM(support) FROM k)
    SELECT label, {rounds(PRF)}, CAST(support AS BIGINT) AS support FROM r""",
)
def classification_report(spark, sf_dir):
    return rounded(evaluate.classification_report(scored_events(spark, sf_dir)), PRF)


def auc_sql(source: str, by: str = "", having: str = "", alias: str = "") -> str:
    """Pairwise rank sum per group, ties half."""
    key, part = (f"{by} AS {alias or by}, ", f"PARTITION BY {alias or by}") if by else ("", "")
    group = f"{alias or by}, " if by else ""
    return f"""g AS (SELECT {key}predicted_prob AS p, SUM(actual) AS pos, COUNT(*) - SUM(actual) AS neg FROM {source} GROUP BY ALL),
      c AS (SELECT *, coalesce(SUM(neg) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM g)
      SELECT {group}round(CAST(SUM(pos * (lower + neg / 2)) AS DOUBLE) / (SUM(pos) * SUM(neg)), 6) AS auc,
        round(SUM(pos) / SUM(pos + neg), 6) AS congestion_rate, CAST(SUM(pos + neg) AS BIGINT) AS n
      FROM c {"GROUP BY " + (alias or by) if by else ""} HAVING SUM(pos) > 0 AND SUM(neg) > 0 {having}"""


AUC = ["auc", "congestion_rate"]


@query("roc_auc", f"WITH {S}, {auc_sql('s')}")
def roc_auc(spark, sf_dir):
    return rounded(evaluate.roc_auc(scored_events(spark, sf_dir)), AUC)


@query("auc_by_station", f"WITH {SD}, {auc_sql('s', 'station_complex')}")
def auc_by_station(spark, sf_dir):
    return rounded(evaluate.roc_auc(scored_orders(spark, sf_dir), ["station_complex"]), AUC)


@query(
    "auc_by_borough",
    f"""WITH {SD}, places AS (SELECT DISTINCT station_complex, borough FROM d),
    sb AS (SELECT s.*, borough FROM s JOIN places USING (station_complex)), {auc_sql('sb', 'borough')}""",
)
def auc_by_borough(spark, sf_dir):
    places = orders_view(spark, sf_dir).select("station_complex", "borough").distinct()
    return rounded(evaluate.auc_ranking(scored_orders(spark, sf_dir).join(places, "station_complex"), "borough"), AUC)


@query(
    "normalised_ridership",
    f"""WITH {HH} SELECT *, round((ridership - min(ridership) OVER w) / (max(ridership) OVER w - min(ridership) OVER w + 1e-6), 6) AS ridership_norm
    FROM hh WINDOW w AS (PARTITION BY station_complex)""",
)
def normalised_ridership(spark, sf_dir):
    return rounded(evaluate.normalise_ridership(events_table(spark, sf_dir)), ["ridership_norm"])


BY_MONTH = auc_sql("s", "strftime(transit_timestamp, '%Y-%m')", "AND SUM(pos + neg) >= 150", "month_label")


@query("auc_by_month", f"WITH {SD}, {BY_MONTH}")
def auc_by_month(spark, sf_dir):
    return rounded(evaluate.auc_by_month(scored_orders(spark, sf_dir), min_rows=150), AUC)


@query("mean_monthly_auc", f"WITH {SD}, m AS (WITH {BY_MONTH}) SELECT round(AVG(auc), 5) AS mean_auc, COUNT(*) AS groups FROM m")
def mean_monthly_auc(spark, sf_dir):
    monthly = evaluate.auc_by_month(scored_orders(spark, sf_dir), min_rows=150)
    return rounded(evaluate.mean_auc(monthly), ["mean_auc"], 5)


CURVE = """g AS (SELECT predicted_prob AS p, SUM(actual) AS pos, COUNT(*) - SUM(actual) AS neg FROM s GROUP BY 1),
  c AS (SELECT p, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS ap, SUM(neg) OVER () AS an,
    lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS place FROM g WINDOW w AS (ORDER BY p DESC)),
  k AS (SELECT p AS threshold, fp / an AS fpr, tp / ap AS tpr FROM c {where}
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0) SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM k"""


@query("roc_points", f"WITH {S}, {CURVE.format(where='WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg')}")
def roc_points(spark, sf_dir):
    return rounded(evaluate.roc_points(scored_events(spark, sf_dir)), ["threshold", "fpr", "tpr"])


@query("roc_points_all", f"WITH {S}, {CURVE.format(where='')}")
def roc_points_all(spark, sf_dir):
    return rounded(evaluate.roc_points(scored_events(spark, sf_dir), drop_intermediate=False), ["threshold", "fpr", "tpr"])


BIN = " + ".join(f"CAST(predicted_prob > CAST({i * 0.1!r} AS DOUBLE) AS INTEGER)" for i in range(1, 10))


@query(
    "calibration",
    f"""WITH {S} SELECT CAST({BIN} AS INTEGER) AS bin, round(AVG(predicted_prob), 6) AS mean_predicted,
    round(AVG(actual), 6) AS fraction_positive, COUNT(*) AS n FROM s GROUP BY 1""",
)
def calibration(spark, sf_dir):
    return rounded(evaluate.calibration_curve(scored_events(spark, sf_dir)), ["mean_predicted", "fraction_positive"])


@query(
    "score_histogram",
    f"""WITH {S}, span AS (SELECT actual, MIN(predicted_prob) AS lo, MAX(predicted_prob) AS hi FROM s GROUP BY 1),
    b AS (SELECT s.actual, least(49, CAST(floor((predicted_prob - lo) / ((hi - lo) / 50)) AS INTEGER)) AS bin, COUNT(*) AS n
      FROM s JOIN span ON s.actual = span.actual GROUP BY 1, 2),
    f AS (SELECT actual, lo, hi, CAST(unnest(range(50)) AS INTEGER) AS bin FROM span)
    SELECT f.actual, f.bin, round(lo + f.bin * ((hi - lo) / 50), 6) AS left_edge, coalesce(n, 0) AS n
    FROM f LEFT JOIN b ON f.actual = b.actual AND f.bin = b.bin""",
)
def score_histogram(spark, sf_dir):
    return rounded(evaluate.score_histogram(scored_events(spark, sf_dir)), ["left_edge"])


@query(
    "high_conf_fn",
    f"""WITH {S} SELECT station_complex, transit_timestamp, ridership, CAST(hour(transit_timestamp) AS INTEGER) AS hour,
    CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week, round(predicted_prob, 6) AS predicted_prob
    FROM s WHERE actual = 1 AND predicted_prob < 0.1""",
)
def high_conf_fn(spark, sf_dir):
    return rounded(evaluate.high_confidence_misses(scored_events(spark, sf_dir)), ["predicted_prob"])


PATTERN = ["predicted", "actual", "predicted_scaled"]


@query(
    "hourly_pattern",
    f"""WITH {S}, span AS (SELECT station_complex, MIN(ridership) AS lo, MAX(ridership) AS hi FROM s GROUP BY 1),
    h24 AS (SELECT CAST(hour(transit_timestamp) AS INTEGER) AS hour, AVG(predicted_prob) AS predicted,
      AVG((ridership - lo) / (hi - lo + 1e-6)) AS actual FROM s JOIN span USING (station_complex) GROUP BY 1),
    r AS (SELECT *, (predicted - MIN(predicted) OVER ()) / (MAX(predicted) OVER () - MIN(predicted) OVER ())
      * (MAX(actual) OVER () - MIN(actual) OVER ()) + MIN(actual) OVER () AS predicted_scaled FROM h24)
    SELECT hour, {rounds(PATTERN)},
      CAST(row_number() OVER (ORDER BY predicted DESC, hour) = 1 AS INTEGER) AS is_predicted_peak,
      CAST(row_number() OVER (ORDER BY actual DESC, hour) = 1 AS INTEGER) AS is_actual_peak FROM r""",
)
def hourly_pattern(spark, sf_dir):
    return rounded(evaluate.hourly_pattern(scored_events(spark, sf_dir)), PATTERN)


@query(
    "class_balance",
    f"""WITH {S} SELECT COUNT(*) FILTER (is_congested = 1) AS positives, COUNT(*) FILTER (is_congested = 0) AS negatives,
    round(COUNT(*) FILTER (is_congested = 0) / COUNT(*) FILTER (is_congested = 1), 6) AS positive_weight FROM s""",
)
def class_balance(spark, sf_dir):
    return rounded(model.class_balance(congestion_label(spark, sf_dir)), ["positive_weight"])


# --- training and evaluation frames ----------------------------------------------------------
# a station has about eight orders a month in the small tables, so lags are short
BRIEF = dict(lags=(1, 3), mean_windows=(2, 4), std_windows=(4,))
KEPT = f"""{DD}, {calendar_sql(1998, 2002)}, w AS (SELECT * FROM dd WHERE transit_timestamp >= '1999-01-01' AND transit_timestamp < '2001-01-01'),
  f AS ({lag_sql('w', (1, 3), (2, 4), (4,), MONTHLY, 4)}),
  k AS (SELECT *, {holiday_sql()} FROM f WHERE lag_3 IS NOT NULL AND roll_mean_2 IS NOT NULL AND roll_mean_4 IS NOT NULL AND roll_std_4 IS NOT NULL)"""
SHOWN = ["transit_timestamp", "station_complex", "ridership", "lag_1", "lag_3", "is_holiday", "is_holiday_eve", "is_congested"]


def order_stations(spark, sf_dir):
    return build_station_features(orders_view(spark, sf_dir), (1999, 2000))


@query(
    "training_frames",
    f"""WITH {KEPT}, {LIMITS.format(source='k', where='year(transit_timestamp) = 1999')},
    l1 AS ({label_sql('k', 'year(transit_timestamp) = 1999')}), l2 AS ({label_sql('k', 'year(transit_timestamp) = 2000')})
    SELECT 'train' AS part, {', '.join(SHOWN)} FROM l1 UNION ALL SELECT 'test', {', '.join(SHOWN)} FROM l2""",
)
def training_frames(spark, sf_dir):
    train, test, _ = training.build_training_data(orders_view(spark, sf_dir), order_stations(spark, sf_dir), 1999, 2000, **BRIEF)
    part = lambda df, name: df.select(F.lit(name).alias("part"), *SHOWN)
    return part(train, "train").unionByName(part(test, "test"))


@query(
    "evaluation_set",
    f"""WITH {KEPT}, {LIMITS.format(source='dd', where='year(transit_timestamp) = 1999')},
    late AS (SELECT * FROM k WHERE transit_timestamp >= '2000-03-01')
    {label_sql('late').replace("x.* EXCLUDE (later)", ", ".join("x." + c for c in SHOWN[:-1]))}""",
)
def evaluation_set(spark, sf_dir):
    limits = labels.congestion_thresholds(orders_table(spark, sf_dir).where(F.year("transit_timestamp") == 1999))
    limits = materialise(limits, "thresholds")
    df = training.evaluation_set(
        orders_view(spark, sf_dir), order_stations(spark, sf_dir), limits, "2000-03-01", "2001-01-01", **BRIEF
    )
    return df.select(*SHOWN)


@query(
    "auc_progress",
    f"""WITH {S}, one AS (SELECT * FROM s WHERE station_complex = 'Plain Plaza'), a AS (WITH {auc_sql('one')}), b AS (WITH {auc_sql('s')})
    SELECT 'one station' AS stage, auc, n FROM a UNION ALL SELECT 'all stations', auc, n FROM b""",
)
def auc_progress(spark, sf_dir):
    path = scratch_path(spark, "progress")
    scored_frame = materialise(scored_events(spark, sf_dir), "scored")
    stages = {"one station": scored_frame.where("station_complex = 'Plain Plaza'"), "all stations": scored_frame}
    for stage, frame in stages.items():
        model.record_metric(spark, path, stage, evaluate.roc_auc(frame))
    return rounded(model.load_table(spark, path), ["auc"])
