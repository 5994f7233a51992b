"""Station-shaped views of the given test tables, for Spark and as SQL text."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.functions.timeparts import hour_floor
from stationflow.schema import STATION

NAMES = ["Hub St (S,4,5)", "Cross Av (N)/62 St (D)", "Pelham Bay Park (6)", "Loop Rd (C, A)", "Plain Plaza"]
EVENT_BOROUGHS = ["Manhattan", "Brooklyn", "Bronx", "Queens", "Staten Island"]


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return reduce(lambda c, iv: c.when(index == iv[0], iv[1]), list(enumerate(values))[1:], F.when(index == 0, values[0]))


def events_view(events: DataFrame) -> DataFrame:
    """Five stations with hourly records, from an `events` frame (batch or stream)."""
    n = F.col("user_id") % 5
    return events.select(
        hour_floor(F.col("ts")).alias("transit_timestamp"),
        _pick(n, NAMES).alias(STATION),
        n.cast("string").alias("station_complex_id"),
        _pick(n, EVENT_BOROUGHS).alias("borough"),
        F.col("event_type").alias("payment_method"),
        F.col("value").cast("decimal(18,2)").alias("ridership"),
        F.lit(0.0).alias("transfers"),
        (F.lit(40.60) + n * F.lit(0.05)).alias("latitude"),
        (F.lit(-74.00) + n * F.lit(0.02)).alias("longitude"),
    )


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view(table(spark, sf_dir, "events"))


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 stations in 5 boroughs over several years."""
    orders, customer, nation, region = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return joined.select(
        (F.col("o_orderdate") + hours).alias("transit_timestamp"),
        F.col("n_name").alias(STATION),
        F.col("n_nationkey").cast("string").alias("station_complex_id"),
        F.col("r_name").alias("borough"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("ridership"),
    )


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12 names of 6 stations, with and without a known form."""
    even = F.col("p_partkey") % 2 == 0
    known = (
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), even)
        .when(F.col("p_type").isin("LARGE", "MEDIUM"), ~even)
        .otherwise(F.col("p_type") == "PROMO")
    )
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.concat("p_type", F.when(even, " (A,C,1)").otherwise(" (C,1,A)")).alias(STATION))
        .agg(F.avg("p_retailprice").alias("prob"), F.count(F.lit(1)).alias("n"), F.bool_or(known).alias("known"))
    )


# --- the same views as SQL -------------------------------------------------------------
def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


H = f"""h AS (SELECT date_trunc('hour', ts) AS transit_timestamp,
  {_case('user_id % 5', NAMES)} AS station_complex, CAST(user_id % 5 AS VARCHAR) AS station_complex_id,
  {_case('user_id % 5', EVENT_BOROUGHS)} AS borough, event_type AS payment_method,
  CAST(value AS DECIMAL(18,2)) AS ridership, CAST(0 AS DOUBLE) AS transfers,
  CAST(40.60 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE) * CAST(0.05 AS DOUBLE) AS latitude,
  CAST(-74.00 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE) * CAST(0.02 AS DOUBLE) AS longitude FROM events)"""

D = """d AS (SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS transit_timestamp,
  n_name AS station_complex, CAST(n_nationkey AS VARCHAR) AS station_complex_id, r_name AS borough,
  o_orderpriority AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS ridership
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

P = """p AS (SELECT concat(p_type, CASE p_partkey % 2 WHEN 0 THEN ' (A,C,1)' ELSE ' (C,1,A)' END) AS station_complex,
  avg(p_retailprice) AS prob, count(*) AS n,
  bool_or(CASE WHEN p_type IN ('ECONOMY','SMALL') THEN p_partkey % 2 = 0
    WHEN p_type IN ('LARGE','MEDIUM') THEN p_partkey % 2 = 1 ELSE p_type = 'PROMO' END) AS known
  FROM part GROUP BY 1)"""


def hourly_sql(source: str, name: str, where: str = "TRUE") -> str:
    return (
        f"{name} AS (SELECT transit_timestamp, station_complex, CAST(SUM(ridership) AS DOUBLE) AS ridership "
        f"FROM {source} WHERE {where} GROUP BY 1, 2)"
    )


HH = H + ", " + hourly_sql("h", "hh")
DD = D + ", " + hourly_sql("d", "dd")
