"""Evaluation of scored frames: `predicted_prob`, `predicted`, `actual`.

Ranking metrics order scores. They first collapse rows to one count per
distinct score, then sum inside score bins and over the short list of bins, so
no task sorts all scores of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.operators.ordered import running_sum
from stationflow.schema import RIDERSHIP, STATION, TARGET_COL, TS
from stationflow.session import materialise

SCORE, ACTUAL, PREDICTED = "predicted_prob", "actual", "predicted"


# --- splits -------------------------------------------------------------------------
def year_split(df: DataFrame, train_year: int = 2023, test_year: int = 2024) -> tuple[DataFrame, DataFrame]:
    year = F.year(TS)
    return df.where(year == train_year), df.where(year == test_year)


def chronological_split(df: DataFrame, fraction: float = 0.8, ties: Sequence[str] = (STATION,)) -> DataFrame:
    """Mark the first `fraction` of all rows in time order as `is_train`.

    Counts per timestamp tell where the cut falls; only the rows of that one
    timestamp are put in order, all others are compared with it.
    """
    counts = df.groupBy(TS).agg(F.count(F.lit(1)).alias("_n"))
    ends = running_sum(counts, [], [TS], F.col(TS).cast("date"), F.col("_n"), "_end", "_rows")
    cut, before = F.floor(F.lit(fraction) * F.col("_rows")), F.col("_end") - F.col("_n")
    found = ends.where((before < cut) & (cut <= F.col("_end")))
    at = found.select(F.struct(F.col(TS).alias("ts"), (cut - before).alias("left")).alias("_at"))
    marked = df.withColumn("_at", at.scalar())
    here = F.col("_at").isNotNull() & F.col(TS).eqNullSafe(F.col("_at.ts"))
    earlier = F.col("_at.ts").isNotNull() & (F.col(TS).isNull() | (F.col(TS) < F.col("_at.ts")))
    place = F.row_number().over(Window.partitionBy(TS).orderBy(*ties))
    others = marked.where(~here).withColumn("is_train", F.coalesce(earlier, F.lit(False)).cast("int"))
    tied = marked.where(here).withColumn("is_train", (place <= F.col("_at.left")).cast("int"))
    return others.unionByName(tied).drop("_at")


# --- rates and drift ------------------------------------------------------------------
def congestion_rate(df: DataFrame, by: Sequence[str] = (), target: str = TARGET_COL) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(target).alias("congestion_rate"), F.count(F.lit(1)).alias("n"))


def congestion_drift(train: DataFrame, test: DataFrame, target: str = TARGET_COL) -> DataFrame:
    """Rate per station in two sets and its change; stations in one set only are left out."""
    before = train.groupBy(STATION).agg(F.avg(target).alias("train_rate"))
    after = test.groupBy(STATION).agg(F.avg(target).alias("test_rate"))
    both = before.join(after, STATION)
    return both.withColumn("drift", F.col("test_rate") - F.col("train_rate")).orderBy(F.desc("drift"), STATION)


def largest_drifts(drift: DataFrame, k: int = 20, limit: float = 0.02) -> DataFrame:
    """The k strongest gains and the k strongest declines beyond `limit`."""
    gains = drift.where(F.col("drift") > limit).orderBy(F.desc("drift"), STATION).limit(k)
    declines = drift.where(F.col("drift") < -limit).orderBy("drift", STATION).limit(k)
    return gains.unionByName(declines).orderBy("drift", STATION)


# --- threshold metrics ----------------------------------------------------------------
def confusion_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy(ACTUAL, PREDICTED).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""

    def hits(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(ACTUAL) == actual) & (F.col(PREDICTED) == predicted)).cast("double")

    cells = df.agg(hits(0, 0).alias("tn"), hits(0, 1).alias("fp"), hits(1, 0).alias("fn"), hits(1, 1).alias("tp"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def of_class(name: str, right: str, wrong: str, missed: str) -> DataFrame:
        r, w, m = F.col(right), F.col(wrong), F.col(missed)
        return F.struct(
            F.lit(name).alias("label"), ratio(r, r + w).alias("precision"), ratio(r, r + m).alias("recall"),
            ratio(2 * r, 2 * r + w + m).alias("f1_score"), (r + m).alias("support"),
        )

    both = cells.select(
        "*", of_class("0", "tn", "fn", "fp").alias("c0"), of_class("1", "tp", "fp", "fn").alias("c1")
    ).withColumn("all", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
    accuracy = ratio(F.col("tn") + F.col("tp"), F.col("all"))

    def average(name: str, w0: Column, w1: Column) -> Column:
        mean = lambda m: ratio(F.col(f"c0.{m}") * w0 + F.col(f"c1.{m}") * w1, w0 + w1).alias(m)
        return F.struct(
            F.lit(name).alias("label"), mean("precision"), mean("recall"), mean("f1_score"), F.col("all").alias("support")
        )

    rows = F.array(
        F.col("c0"),
        F.col("c1"),
        F.struct(
            F.lit("accuracy").alias("label"), accuracy.alias("precision"), accuracy.alias("recall"),
            accuracy.alias("f1_score"), F.col("all").alias("support"),
        ),
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", F.col("c0.support"), F.col("c1.support")),
    )
    return both.select(F.inline(rows)).withColumn("support", F.col("support").cast("long"))


def high_confidence_misses(df: DataFrame, below: float = 0.1) -> DataFrame:
    """Busy hours that were given a very low probability."""
    return df.where((F.col(ACTUAL) == 1) & (F.col(SCORE) < below)).select(
        STATION, TS, RIDERSHIP, F.hour(TS).alias("hour"), F.weekday(TS).alias("day_of_week"), SCORE
    )


# --- ranking metrics ------------------------------------------------------------------
def _score_bin(p: Column) -> Column:
    """A whole number that rises with the score; fine near 0 and 1, where
    classifier scores crowd. Beyond 0 and 1, as for raw margins, bins widen with the distance."""
    beyond = lambda d: F.floor(F.least(F.log1p(d) * 500, F.lit(400_000.0))).cast("int")
    return (
        F.when(p <= 0, -20_000 - beyond(-p))
        .when(p >= 1, 20_000 + beyond(p - 1))
        .otherwise(F.greatest(F.lit(-20_000), F.least(F.lit(20_000), F.floor(F.log(p / (1 - p)) * 500).cast("int"))))
    )


def _score_counts(df: DataFrame, by: Sequence[str], score: str, actual: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    y = F.col(actual)
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("_s"))
        .agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
        .withColumn("_bin", _score_bin(F.col("_s")))
    )


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), score: str = SCORE, actual: str = ACTUAL, min_rows: int = 1
) -> DataFrame:
    """Area under the ROC curve, tied scores counted half, with the rate and row count.

    Groups (or the whole frame) with one class only, or fewer than `min_rows`
    rows, have no AUC and are left out.
    """
    by = list(by)
    counts = _score_counts(df, by, score, actual)
    within = Window.partitionBy(*by, "_bin").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("_neg").over(within), F.lit(0))
    wins = F.col("_pos").cast("double") * (lower + F.col("_neg") / 2)
    bins = (
        counts.withColumn("_wins", wins)
        .groupBy(*by, "_bin")
        .agg(F.sum("_wins").alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_neg").over(earlier), F.lit(0))
    whole = bins.withColumn("_wins", F.col("_wins") + F.col("_pos").cast("double") * base)
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    return (
        whole.groupBy(*by)
        .agg(F.sum("_wins").alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        .where((F.col("_pos") > 0) & (F.col("_neg") > 0) & (F.col("_pos") + F.col("_neg") >= min_rows))
        .select(
            *by,
            (F.col("_wins") / (pos * neg)).alias("auc"),
            (pos / (pos + neg)).alias("congestion_rate"),
            (F.col("_pos") + F.col("_neg")).alias("n"),
        )
    )


def auc_by_month(df: DataFrame, min_rows: int = 1000) -> DataFrame:
    return roc_auc(df.withColumn("month_label", F.date_format(TS, "yyyy-MM")), ["month_label"], min_rows=min_rows)


def mean_auc(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.avg("auc").alias("mean_auc"), F.count(F.lit(1)).alias("groups"))


def roc_points(
    df: DataFrame, score: str = SCORE, actual: str = ACTUAL, drop_intermediate: bool = True
) -> DataFrame:
    """ROC curve: rates at each distinct score from the highest down.

    The curve opens at (0, 0) with an infinite threshold. `drop_intermediate`
    leaves out points on a straight line between their neighbours; the first
    and the last score always stay.
    """
    counts = _score_counts(df, [], score, actual)
    bins = counts.groupBy("_bin").agg(
        F.sum("_pos").alias("_bin_pos"), F.sum("_neg").alias("_bin_neg"),
        F.max_by(F.struct("_pos", "_neg"), "_s").alias("_first"),
    )
    down = Window.orderBy(F.desc("_bin"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # at most 40,001 bins: the one table small enough for a window without keys
    starts = bins.select(
        F.col("_bin").alias("_b"),
        F.coalesce(F.sum("_bin_pos").over(above), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_bin_neg").over(above), F.lit(0)).alias("_neg_above"),
        F.sum("_bin_pos").over(everything).alias("_all_pos"),
        F.sum("_bin_neg").over(everything).alias("_all_neg"),
        F.lead("_first").over(down).alias("_next_first"),
        (F.row_number().over(down) == 1).alias("_top"),
    )
    within = Window.partitionBy("_bin").orderBy(F.desc("_s"))
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    points = (
        counts.withColumns(
            {
                "_in_pos": F.sum("_pos").over(so_far),
                "_in_neg": F.sum("_neg").over(so_far),
                "_next": F.lead(F.struct("_pos", "_neg")).over(within),
                "_place": F.row_number().over(within),
            }
        )
        .join(starts, F.col("_bin") == F.col("_b"))
        .withColumn("_next", F.coalesce("_next", "_next_first"))
    )
    tp, fp = F.col("_in_pos") + F.col("_pos_above"), F.col("_in_neg") + F.col("_neg_above")
    if drop_intermediate:
        bend = (F.col("_next._pos") != F.col("_pos")) | (F.col("_next._neg") != F.col("_neg"))
        first = F.col("_top") & (F.col("_place") == 1)
        points = points.where(first | F.col("_next").isNull() | bend)
    curve = points.select(
        F.col("_s").alias("threshold"),
        F.try_divide(fp, F.col("_all_neg")).alias("fpr"),
        F.try_divide(tp, F.col("_all_pos")).alias("tpr"),
    )
    opening = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return opening.unionByName(curve)


# --- calibration and distributions -------------------------------------------------------
def calibration_curve(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per equal-width, right-closed score bin."""
    width = 1.0 / bins
    bin_no = sum(((F.col(SCORE) > i * width).cast("int") for i in range(1, bins)), F.lit(0))
    return df.groupBy(bin_no.alias("bin")).agg(
        F.avg(SCORE).alias("mean_predicted"), F.avg(ACTUAL).alias("fraction_positive"), F.count(F.lit(1)).alias("n")
    )


def score_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Counts per class in equal-width bins over that class's own score range. The two columns are written once."""
    df = materialise(df.select(ACTUAL, SCORE), "scores")
    edges = []
    for label in (0, 1):
        own = F.when(F.col(ACTUAL) == label, F.col(SCORE))
        edges += [F.min(own).alias(f"lo{label}"), F.max(own).alias(f"hi{label}")]
    span = df.agg(F.struct(*edges).alias("span"))

    def bounds(source: str, label: Column) -> tuple[Column, Column]:
        lo = F.when(label == 0, F.col(f"{source}.lo0")).otherwise(F.col(f"{source}.lo1"))
        hi = F.when(label == 0, F.col(f"{source}.hi0")).otherwise(F.col(f"{source}.hi1"))
        pad = F.when(lo == hi, 0.5).otherwise(0.0)
        return lo - pad, (hi - lo + pad * 2) / bins

    low, step = bounds("_span", F.col(ACTUAL))
    place = F.least(F.lit(bins - 1), F.floor((F.col(SCORE) - low) / step).cast("int"))
    counted = (
        df.select(ACTUAL, SCORE)
        .withColumn("_span", span.scalar())
        .groupBy(ACTUAL, place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    frame = span.select(
        "span", F.explode(F.array(F.lit(0), F.lit(1))).alias(ACTUAL)
    ).select("span", ACTUAL, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    low, step = bounds("span", F.col(ACTUAL))
    frame = frame.select(ACTUAL, "bin", (low + F.col("bin") * step).alias("left_edge")).where("left_edge IS NOT NULL")
    return frame.join(counted, [ACTUAL, "bin"], "left").select(
        ACTUAL, "bin", "left_edge", F.coalesce("_n", F.lit(0)).alias("n")
    )


def normalise_ridership(df: DataFrame, by: str = STATION, value: str = RIDERSHIP, name: str = "ridership_norm") -> DataFrame:
    """`df` with `name`: every row's place between the least and largest `value` of its station, from 0 to just below 1.

    A station with one value gets 0, a null value stays null. The ranges are a small table of their own, so no station is gathered.
    """
    ranges = df.groupBy(F.col(by).alias("_by")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    joined = df.join(materialise(ranges, "ranges"), F.col(by).eqNullSafe(F.col("_by")), "left")
    return joined.withColumn(name, (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1e-6)).select(*df.columns, name)


def auc_ranking(df: DataFrame, by: str) -> DataFrame:
    """AUC and rows of each group with two classes, the lowest AUC first."""
    return roc_auc(df.where(F.col(by).isNotNull()), [by]).orderBy("auc", by)


def hourly_pattern(df: DataFrame) -> DataFrame:
    """Mean score beside mean normalised ridership per hour, the score rescaled to
    the range of the ridership, and the peak hour of each."""
    # sums per station and hour first: the normalised mean follows from them, so
    # the rows are read once and never joined to their station's range
    cells = df.groupBy(STATION, F.hour(TS).alias("hour")).agg(
        F.sum(SCORE).alias("_p"), F.count(SCORE).alias("_np"),
        F.sum(RIDERSHIP).alias("_x"), F.count(RIDERSHIP).alias("_nx"),
        F.min(RIDERSHIP).alias("_lo"), F.max(RIDERSHIP).alias("_hi"),
    )
    station = Window.partitionBy(STATION)
    lowest, highest = F.min("_lo").over(station), F.max("_hi").over(station)
    norm = (F.col("_x") - F.col("_nx") * lowest) / (highest - lowest + 1e-6)
    hourly = (
        cells.withColumn("_norm", norm)
        .groupBy("hour")
        .agg(
            F.try_divide(F.sum("_p"), F.sum("_np")).alias("predicted"),
            F.try_divide(F.sum("_norm"), F.sum("_nx")).alias("actual"),
        )
    )
    day = Window.partitionBy()  # 24 rows
    lo = lambda c: F.min(c).over(day)
    hi = lambda c: F.max(c).over(day)
    scaled = F.try_divide(F.col("predicted") - lo("predicted"), hi("predicted") - lo("predicted"))
    shaped = hourly.withColumn("predicted_scaled", scaled * (hi("actual") - lo("actual")) + lo("actual"))
    peak = lambda c: (F.col("hour") == F.max_by("hour", F.struct(F.col(c), -F.col("hour"))).over(day)).cast("int")
    return shaped.withColumns(
        {"is_predicted_peak": peak("predicted_scaled"), "is_actual_peak": peak("actual")}
    ).orderBy("hour")
