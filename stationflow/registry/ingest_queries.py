"""Registered queries: landed pages, partitioned tables, streams, models.

Each writes the given tables into the session's shared folder in the form of
the feed, takes them in again and returns what was stored.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from stationflow.functions.timeparts import iso_text
from stationflow.operators.evaluate import roc_auc
from stationflow.operators.labels import add_congestion_label, congestion_thresholds
from stationflow.operators.rollups import hourly_ridership
from stationflow.plans import backfill, model, training
from stationflow.plans.boosting import log_loss
from stationflow.registry.adapters import D, H, HH, events_view, hourly_events, orders_view, table
from stationflow.registry.base import query, rounded
from stationflow.registry.feature_queries import LIMITS, event_stations, label_sql
from stationflow.schema import FEATURE_COLS
from stationflow.session import materialise, scratch_path
from stationflow.sources import commits, facts, intake, landed, sinks
from stationflow.streaming import ingest, rollup

AS_STORED = """SELECT transit_timestamp, station_complex_id, station_complex, borough, payment_method,
  CAST(ridership AS DOUBLE) AS ridership, {rest} FROM {source}"""
EVENT_REST = "transfers, latitude, longitude, CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month"
ORDER_REST = """CAST(NULL AS DOUBLE) AS transfers, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
  CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month"""


def as_landed(df: DataFrame) -> DataFrame:
    """A frame in the form of the feed: text columns and a nested location."""
    text = [
        (F.concat(iso_text(F.col(c)), F.lit(".000")) if c == "transit_timestamp" else F.col(c).cast("string")).alias(c)
        for c in df.columns
    ]
    return df.select(*text, F.struct(F.lit("Point").alias("type")).alias("georeference"))


def land(df: DataFrame, path: str) -> str:
    as_landed(df).write.json(path)
    return path


@query("clean_cast", f"WITH {H} {AS_STORED.format(source='h', rest='transfers, latitude, longitude')}")
def clean_cast(spark, sf_dir):
    pages = land(hourly_events(spark, sf_dir), scratch_path(spark, "pages"))
    return landed.clean(landed.read_landed(spark, pages, lines=True))


@query("clean_marked", f"WITH {H} SELECT COUNT(*) AS rows, COUNT(*) FILTER (ridership < 10 OR hour(transit_timestamp) < 4) AS bad FROM h")
def clean_marked(spark, sf_dir):
    text = as_landed(hourly_events(spark, sf_dir))
    spoilt = text.withColumn("ridership", F.when(F.col("ridership").cast("double") < 10, "n/a").otherwise(F.col("ridership")))
    ts, hour = F.col("transit_timestamp"), F.substring("transit_timestamp", 12, 2)
    other = F.when(hour == "00", F.substring(ts, 1, 10)).when(hour == "01", F.concat(ts, F.lit("Z"))).when(hour == "02", F.concat(F.lit(" "), ts)).when(hour == "03", F.substring(ts, 1, 7))
    marked = landed.clean(spoilt.withColumn("transit_timestamp", F.coalesce(other, ts)), on_error="mark")
    return marked.agg(F.count("*").alias("rows"), F.count_if("is_bad").alias("bad"))


@query(
    "source_page",
    f"""WITH {D} SELECT * REPLACE (CAST(ridership AS DOUBLE) AS ridership) FROM d WHERE transit_timestamp >= '1997-01-01'
    ORDER BY transit_timestamp, station_complex, station_complex_id, borough, payment_method, ridership LIMIT 100 OFFSET 200""",
)
def source_page(spark, sf_dir):
    df = orders_view(spark, sf_dir).withColumn("ridership", F.col("ridership").cast("double"))
    return landed.select_page(df, start="1997-01-01", limit=100, offset=200)


@query("partitioned_scan", f"WITH {D} {AS_STORED.format(source='d', rest=ORDER_REST)} WHERE transit_timestamp >= '1998-03-10' AND transit_timestamp < '1999-02-01'")
def partitioned_scan(spark, sf_dir):
    root = scratch_path(spark, "fact")
    sinks.replace_months(landed.clean(as_landed(orders_view(spark, sf_dir))), root)
    return facts.select_range(facts.read_ridership(spark, root), start="1998-03-10", end="1999-02-01")


@query("ridership_view", f"WITH {D} SELECT station_complex, COUNT(*) AS n, CAST(SUM(ridership) AS DOUBLE) AS ridership FROM d WHERE year(transit_timestamp) = 1997 GROUP BY 1")
def ridership_view(spark, sf_dir):
    """A stored table asked with SQL text."""
    root = scratch_path(spark, "fact")
    sinks.replace_months(landed.clean(as_landed(orders_view(spark, sf_dir))), root)
    facts.register_ridership(spark, root, "ridership")
    return spark.sql("SELECT station_complex, COUNT(*) AS n, CAST(SUM(CAST(ridership AS DECIMAL(18, 2))) AS DOUBLE) AS ridership FROM ridership WHERE year = 1997 GROUP BY station_complex")


@query(
    "station_scan",
    f"WITH {D} {AS_STORED.format(source='d', rest=ORDER_REST)} WHERE station_complex = 'NATION_7' AND transit_timestamp >= '1996-03-10' AND transit_timestamp < '1999-02-01'",
)
def station_scan(spark, sf_dir):
    """One station over some years, from months laid out by station."""
    root = scratch_path(spark, "fact")
    sinks.replace_months(landed.clean(as_landed(orders_view(spark, sf_dir))), root, station_layout=True)
    return facts.select_range(facts.read_ridership(spark, root), "NATION_7", "1996-03-10", "1999-02-01")


@query(
    "replace_month",
    f"""WITH {D}, m AS (SELECT year(transit_timestamp) AS y, month(transit_timestamp) AS m, ridership FROM d)
    SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, COUNT(*) AS n,
    CAST(SUM(CASE WHEN y = 1997 AND m = 5 THEN 2 * ridership ELSE ridership END) AS DOUBLE) AS ridership FROM m GROUP BY y, m""",
)
def replace_month(spark, sf_dir):
    """Reload one month with doubled values; the others stay."""
    root = scratch_path(spark, "fact")
    rows = orders_view(spark, sf_dir)
    sinks.replace_months(rows, root)
    backfill.replace_month(rows.withColumn("ridership", (F.col("ridership") * 2).cast("decimal(18,2)")), root, 1997, 5)
    stored = spark.read.schema(facts.partition_keys(rows).schema).parquet(root)
    return stored.groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("ridership").cast("double").alias("ridership"))


@query(
    "append_batches",
    f"WITH {D} SELECT CAST(year(transit_timestamp) AS INTEGER) AS year, COUNT(*) AS n, CAST(SUM(ridership) AS DOUBLE) AS ridership FROM d GROUP BY 1",
)
def append_batches(spark, sf_dir):
    """Two batches, the second written twice: a retry adds nothing."""
    root = scratch_path(spark, "fact")
    rows = orders_view(spark, sf_dir)
    late = F.hour("transit_timestamp") >= 12
    sinks.append_months(rows.where(~late), root, "morning")
    for _ in range(2):
        sinks.append_months(rows.where(late), root, "evening")
    stored = spark.read.schema(facts.partition_keys(rows).schema).parquet(root)
    return stored.groupBy("year").agg(F.count("*").alias("n"), F.sum("ridership").cast("double").alias("ridership"))


PLAN = """plan AS (SELECT CAST(x AS TIMESTAMP) AS start, CAST(x + INTERVAL 1 MONTH AS TIMESTAMP) AS "end", CAST(year(x) AS INTEGER) AS year,
  CAST(month(x) AS INTEGER) AS month FROM generate_series(
    (SELECT date_trunc('year', MIN(transit_timestamp)) FROM d), (SELECT date_trunc('year', MAX(transit_timestamp)) + INTERVAL 11 MONTH FROM d),
    INTERVAL 1 MONTH) t(x))"""


def order_years(spark, sf_dir) -> tuple[int, int]:
    return orders_view(spark, sf_dir).agg(F.min(F.year("transit_timestamp")), F.max(F.year("transit_timestamp"))).first()


@query("month_plan", f"WITH {D}, {PLAN} SELECT * FROM plan")
def month_plan(spark, sf_dir):
    return backfill.month_plan(spark, *order_years(spark, sf_dir))


@query(
    "incomplete_months",
    f"""WITH {D}, {PLAN}, c AS (SELECT year(transit_timestamp) AS y, month(transit_timestamp) AS m, COUNT(*) AS n FROM d GROUP BY 1, 2)
    SELECT plan.*, coalesce(n, 0) AS n FROM plan LEFT JOIN c ON y = year AND m = month WHERE coalesce(n, 0) < 185""",
)
def incomplete_months(spark, sf_dir):
    stored = facts.partition_keys(orders_view(spark, sf_dir))
    return backfill.incomplete_months(backfill.month_plan(spark, *order_years(spark, sf_dir)), stored, min_rows=185)


@query(
    "backfill",
    f"""WITH {D}, m AS (SELECT *, COUNT(*) OVER (PARTITION BY year(transit_timestamp), month(transit_timestamp)) >= 185 AND year(transit_timestamp) = 1997 AS kept FROM d),
    r AS (SELECT * REPLACE (CAST(CASE WHEN kept THEN 2 * ridership ELSE ridership END AS DECIMAL(18,2)) AS ridership) FROM m)
    {AS_STORED.format(source='r', rest=ORDER_REST)} WHERE year(transit_timestamp) BETWEEN 1996 AND 1998""",
)
def run_backfill(spark, sf_dir):
    """1997 is stored with doubled values; its months of 185 rows or more are taken for complete and keep them, the others are loaded."""
    root = scratch_path(spark, "fact")
    rows = landed.clean(as_landed(orders_view(spark, sf_dir)))
    sinks.replace_months(facts.select_range(rows, start="1997-01-01", end="1998-01-01").withColumn("ridership", F.col("ridership") * 2), root)
    backfill.backfill(rows, None, root, 1996, 1998, min_rows=185, counts=backfill.month_counts_from_footers(spark, root))
    return facts.read_ridership(spark, root)


STORED = "transit_timestamp timestamp_ntz, station_complex_id string, station_complex string, borough string, payment_method string, ridership decimal(18,2)"


@query(
    "write_and_mark",
    f"""WITH {D}, w AS (SELECT *, year(transit_timestamp) = 1997 AND month(transit_timestamp) = 5 AS again FROM d WHERE year(transit_timestamp) < 1999),
    c AS (SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN again THEN 2 * ridership ELSE ridership END) AS DOUBLE) AS ridership,
      strftime(MAX(transit_timestamp), '%Y-%m-%dT%H:%M:%S') AS watermark FROM w)
    SELECT * FROM c""",
)
def write_and_mark(spark, sf_dir):
    """Rows up to 1998 and their mark, one month replaced, and a later write that died before it was published."""
    root = scratch_path(spark, "table")
    rows = orders_view(spark, sf_dir)
    mark = commits.commit_months(rows.where(F.year("transit_timestamp") < 1999), root, "first")
    month = rows.where((F.year("transit_timestamp") == 1997) & (F.month("transit_timestamp") == 5))
    commits.commit_months(month.withColumn("ridership", (F.col("ridership") * 2).cast("decimal(18,2)")), root, "again")
    commits.stage(rows.where(F.year("transit_timestamp") >= 1998), root, "died")
    assert mark == commits.newest_mark(spark, root)
    stored = commits.read_committed(spark, root, STORED)
    return stored.agg(F.count("*").alias("n"), F.sum("ridership").cast("double").alias("ridership"), F.lit(commits.newest_mark(spark, root)).alias("watermark"))


@query(
    "compacted_months",
    f"""WITH {D} SELECT CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month, COUNT(*) AS n, CAST(SUM(ridership) AS DOUBLE) AS ridership,
    CAST(1 AS INTEGER) AS versions, COUNT(*) AS counted FROM d GROUP BY 1, 2""",
)
def compacted_months(spark, sf_dir):
    """Four batches appended to every month, then one compaction; `counted` comes from the log."""
    root = scratch_path(spark, "table")
    rows = orders_view(spark, sf_dir)
    for k in range(4):
        commits.commit_months(rows.where(F.hour("transit_timestamp") % 4 == k), root, f"batch-{k}", replace=False)
    commits.compact_months(spark, root, STORED, "compact")
    sums = commits.read_committed(spark, root, STORED).groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("ridership").cast("double").alias("ridership"))
    live = commits.live_versions(spark, root).select("year", "month", F.size("versions").alias("versions"))
    return sums.join(live, ["year", "month"]).join(commits.month_rows(spark, root).withColumnRenamed("n", "counted"), ["year", "month"])


@query(
    "incremental_since",
    f"""WITH {D} SELECT CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month, COUNT(*) AS n,
    CAST(SUM(ridership) AS DOUBLE) AS ridership, strftime((SELECT MAX(transit_timestamp) FROM d), '%Y-%m-%dT%H:%M:%S') AS watermark
    FROM d WHERE transit_timestamp >= '1996-01-01' GROUP BY 1, 2""",
)
def incremental_since(spark, sf_dir):
    """Pages landed in two steps, taken in after each and once more: every run parses new files only."""
    pages, root = scratch_path(spark, "pages"), scratch_path(spark, "table")
    rows = as_landed(orders_view(spark, sf_dir))
    early = F.col("transit_timestamp") < "1999"
    for part in (rows.where(early), rows.where(~early), None):
        if part is not None:
            part.write.mode("append").json(pages)
        intake.take_in(spark, pages, root, start="1996-01-01", lines=True)
    stored = commits.read_committed(spark, root, intake.taken_schema())
    counted = stored.groupBy("year", "month").agg(
        F.count("*").alias("n"), F.sum(F.col("ridership").cast("decimal(18,2)")).cast("double").alias("ridership")
    )
    return counted.withColumn("watermark", F.lit(commits.newest_mark(spark, root)))


# --- streams -------------------------------------------------------------------------------
@query("stream_ingest", f"WITH {H} {AS_STORED.format(source='h', rest=EVENT_REST)}")
def stream_ingest(spark, sf_dir):
    """Pages landed in two steps, the stream run after each and once more."""
    pages, root, checkpoint = (scratch_path(spark, x) for x in ("pages", "fact", "checkpoint"))
    rows = hourly_events(spark, sf_dir)
    late = F.dayofmonth("transit_timestamp") > 15
    for part in (rows.where(~late), rows.where(late), None):
        if part is not None:
            as_landed(part).write.mode("append").json(pages)
        ingest.start_ingest(ingest.landed_stream(spark, pages, lines=True), root, checkpoint).awaitTermination()
    return facts.read_ridership(spark, root)


def event_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return events_view(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"))


@query("stream_hourly", f"WITH {HH} SELECT * FROM hh")
def stream_hourly(spark, sf_dir):
    """Records dealt over four files by a hash, so that hours come in parts and out of order, a micro-batch for each file."""
    landing, root, checkpoint = (scratch_path(spark, x) for x in ("events", "table", "checkpoint"))
    events = table(spark, sf_dir, "events")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(landing)
    stream = events_view(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing))
    rollup.start_hourly_upserts(stream, root, checkpoint).awaitTermination()
    return rollup.hourly_table(stream, root)


@query(
    "stream_hourly_final",
    f"WITH {HH} SELECT * FROM hh WHERE transit_timestamp + INTERVAL 3 HOUR <= (SELECT MAX(transit_timestamp) FROM h)",
)
def stream_hourly_final(spark, sf_dir):
    """Hours that are final: those that ended two hours before the newest record."""
    path, checkpoint = scratch_path(spark, "hourly"), scratch_path(spark, "checkpoint")
    hourly = rollup.hourly_stream(event_stream(spark, sf_dir))
    rollup.start_hourly(hourly, path, checkpoint).awaitTermination()
    return spark.read.schema(hourly.schema).parquet(path)


@query(
    "stream_without_repeats",
    f"WITH {H} SELECT DISTINCT transit_timestamp, station_complex, payment_method FROM h",
)
def stream_without_repeats(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "unique"), scratch_path(spark, "checkpoint")
    keys = ["transit_timestamp", "station_complex", "payment_method"]
    unique = ingest.without_repeats(event_stream(spark, sf_dir), keys).select(*keys)
    rollup.start_hourly(unique, path, checkpoint).awaitTermination()
    return spark.read.schema(unique.schema).parquet(path)


# --- models: SQL says the rows, labels, loss sums and what must hold for any fit ----------------
#: A larger step than the published one, so that the best round comes early: on small tables a round is a second of job starts.
STEP = 0.3

MODEL_ROWS = f"""{HH}, numbered AS (
    SELECT *, row_number() OVER (PARTITION BY station_complex, month(transit_timestamp) ORDER BY transit_timestamp) AS rn FROM hh
    WHERE transit_timestamp >= '2024-01-01' AND transit_timestamp < '2024-02-01'),
  k AS (SELECT transit_timestamp, station_complex, ridership FROM numbered WHERE rn > 168), {LIMITS.format(source='k', where='day(transit_timestamp) <= 22')},
  train AS ({label_sql('k', 'day(transit_timestamp) <= 22')}), test AS ({label_sql('k', 'day(transit_timestamp) > 22')})"""


@lru_cache(maxsize=1)
def fitted(spark, sf_dir):
    """(model, rounds, training rows, test rows): trained on the first weeks, judged on the last."""
    matrix = training.build_features(hourly_events(spark, sf_dir), "2024-01-01", "2024-02-01", event_stations(spark, sf_dir))
    matrix = materialise(matrix, "features")
    early = F.dayofmonth("transit_timestamp") <= 22
    limits = materialise(congestion_thresholds(matrix.where(early)), "thresholds")
    train, test = (materialise(add_congestion_label(df, thresholds=limits), "labelled") for df in (matrix.where(early), matrix.where(~early)))
    return *model.train_with_history(train, test, step=STEP), train, test


@query(
    "train_predict",
    f"""WITH {MODEL_ROWS} SELECT transit_timestamp, station_complex, is_congested AS actual, TRUE AS is_probability, TRUE AS cut_at_half FROM test""",
)
def train_predict(spark, sf_dir):
    booster, _, _, test = fitted(spark, sf_dir)
    result = training.scored(test, lambda df: model.score(booster, df))
    p = F.col("predicted_prob")
    return result.select(
        "transit_timestamp", "station_complex", "actual", p.between(0, 1).alias("is_probability"),
        (F.col("predicted") == (p > 0.5).cast("int")).alias("cut_at_half"),
    )


@query(
    "early_stopping",
    f"""WITH {MODEL_ROWS} SELECT (SELECT COUNT(*) FROM train) AS train_rows, (SELECT COUNT(*) FROM test) AS validation_rows,
    round(ln(2), 6) AS start_loss, TRUE AS best_is_least, TRUE AS stopped_by_patience, TRUE AS kept_best_trees, TRUE AS loss_is_the_models""",
)
def early_stopping(spark, sf_dir):
    """What must hold for the rounds of any run that stopped: 20 rounds after the least loss, whose trees are the model."""
    booster, rounds, train, test = fitted(spark, sf_dir)
    best = F.min_by("round", F.struct("validation_loss", "round"))
    told = rounds.where("round > 0").agg(
        (F.max("round") - best == model.SETTINGS["patience"]).alias("stopped_by_patience"), (best == booster.stages[-1].getNumTrees).alias("kept_best_trees"),
        (F.min(F.when(F.col("is_best"), F.col("validation_loss"))) == F.min("validation_loss")).alias("best_is_least"), F.min("validation_loss").alias("least"),
    )
    start = rounds.where("round = 0").select(F.round("validation_loss", 6).alias("start_loss"))
    counts = train.agg(F.count("*").alias("train_rows")).crossJoin(test.agg(F.count("*").alias("validation_rows")))
    loss = model.score(booster, test).agg(F.avg(log_loss(F.col("is_congested"), F.col("predicted_prob"))).alias("loss"))
    joined = counts.crossJoin(start).crossJoin(told).crossJoin(loss)  # one row each
    return joined.withColumn("loss_is_the_models", F.abs(F.col("loss") - F.col("least")) < 1e-9).drop("loss", "least")


def stumps_sql(rounds: int, step: float, features: list[str]) -> str:
    """Second-order boosting of one-split trees, one CTE a round: the split with the largest gain, its two leaf values, new margins."""
    out = ["m0 AS (SELECT *, CAST(0 AS DOUBLE) AS margin FROM rows)"]
    splits = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, g, h FROM d{{k}}" for f in features)
    value = "CASE split.feature " + " ".join(f"WHEN '{f}' THEN m{{k}}.{f}" for f in features) + " END"
    for k in range(rounds):
        out += [
            f"d{k} AS (SELECT *, scale * (label - 1 / (1 + exp(-margin))) AS g, scale / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h FROM m{k} WHERE NOT held)",
            f"c{k} AS (SELECT feature, x, SUM(SUM(g)) OVER w AS gl, SUM(SUM(h)) OVER w AS hl, SUM(SUM(g)) OVER a AS ga, SUM(SUM(h)) OVER a AS ha FROM ({splits.format(k=k)}) GROUP BY feature, x WINDOW w AS (PARTITION BY feature ORDER BY x), a AS (PARTITION BY feature))",
            f"s{k} AS (SELECT feature, x, gl / hl AS lower_step, (ga - gl) / (ha - hl) AS upper_step FROM c{k} WHERE ha - hl > 1e-9 AND hl >= 1 AND ha - hl >= 1 ORDER BY gl * gl / hl + (ga - gl) * (ga - gl) / (ha - hl) DESC LIMIT 1)",
            f"m{k + 1} AS (SELECT m{k}.* EXCLUDE (margin), margin + {step} * CASE WHEN {value.format(k=k)} <= split.x THEN lower_step ELSE upper_step END AS margin FROM m{k}, s{k} AS split)",
        ]
    return ", ".join(out)


STUMPS = 6
SPLIT_BY = ["hour", "day_of_week"]


@query(
    "boosting_rounds",
    f"""WITH {HH}, {LIMITS.format(source='hh', where='TRUE')}, lab AS ({label_sql('hh')}),
    flat AS (SELECT CAST(hour(transit_timestamp) AS DOUBLE) AS hour, CAST(isodow(transit_timestamp) - 1 AS DOUBLE) AS day_of_week, is_congested AS label, day(transit_timestamp) > 20 AS held FROM lab),
    balance AS (SELECT COUNT(*) FILTER (label = 0) / COUNT(*) FILTER (label = 1) AS w FROM flat WHERE NOT held),
    rows AS (SELECT flat.*, CASE WHEN label = 1 THEN w ELSE 1 END AS scale FROM flat, balance), {stumps_sql(STUMPS, STEP, SPLIT_BY)},
    losses AS ({" UNION ALL ".join(f"SELECT {k} AS round, held, -ln(CASE WHEN label = 1 THEN 1 / (1 + exp(-margin)) ELSE 1 - 1 / (1 + exp(-margin)) END) AS loss FROM m{k}" for k in range(STUMPS + 1))})
    SELECT CAST(round AS INTEGER) AS round, round(AVG(loss) FILTER (NOT held), 6) AS train_loss, round(AVG(loss) FILTER (held), 6) AS validation_loss FROM losses GROUP BY 1""",
)
def boosting_rounds(spark, sf_dir):
    """Losses of six rounds of one-split trees over hours and weekdays, all rows and columns in every round."""
    labelled = add_congestion_label(hourly_ridership(hourly_events(spark, sf_dir)))
    flat = labelled.select(F.hour("transit_timestamp").alias("hour"), F.weekday("transit_timestamp").alias("day_of_week"), "is_congested", (F.dayofmonth("transit_timestamp") > 20).alias("held"))
    flat = materialise(flat, "rows")
    _, rounds = model.train_with_history(
        flat.where("not held"), flat.where("held"), SPLIT_BY, rounds=STUMPS, depth=1, step=STEP, row_share=1.0, column_share=1.0, bins=32, patience=None,
    )
    return rounded(rounds.drop("is_best"), ["train_loss", "validation_loss"])


@query("feature_importance", "SELECT CAST(range AS INTEGER) AS place, TRUE AS is_input, TRUE AS in_order, TRUE AS sums_to_one FROM range(1, 21)")
def feature_importance(spark, sf_dir):
    """The twenty first inputs by gain: what must hold for any fit."""
    ranked = model.feature_importance(spark, fitted(spark, sf_dir)[0]).toPandas()  # as long as the list of inputs
    whole = abs(ranked.importance.sum() - 1) < 1e-6
    top = ranked.head(20)
    rows = [(k + 1, f in [*FEATURE_COLS, model.KNOWN_FLAG], bool(k == 0 or top.importance[k] <= top.importance[k - 1]), bool(whole)) for k, f in enumerate(top.feature)]
    return spark.createDataFrame(rows, "place int, is_input boolean, in_order boolean, sums_to_one boolean")


@query("saved_model_auc", f"WITH {MODEL_ROWS} SELECT COUNT(*) AS n, TRUE AS same_auc, TRUE AS same_scores FROM test")
def saved_model_auc(spark, sf_dir):
    """A saved and loaded model scores like the fitted one."""
    booster, _, _, test = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.save_model(booster, path)
    reloaded = model.load_model(path)
    (before, after) = (materialise(training.scored(test, lambda df: model.score(m, df)), "scored") for m in (booster, reloaded))
    keys = ["transit_timestamp", "station_complex"]
    other = after.select(*keys, F.col("predicted_prob").alias("_again"))
    same = before.join(other, keys, "left").agg(F.bool_and(F.col("predicted_prob").eqNullSafe(F.col("_again"))).alias("same_scores"))
    both = roc_auc(before).select(F.col("auc").alias("_a")).crossJoin(roc_auc(after)).crossJoin(same)  # one row each
    return both.select(F.col("n").cast("long").alias("n"), F.col("auc").eqNullSafe(F.col("_a")).alias("same_auc"), "same_scores")
