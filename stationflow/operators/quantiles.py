"""Exact, linearly interpolated quantiles of groups of any size.

The built-in exact `percentile` keeps every distinct value of a group in one
buffer. Here a mergeable sketch first brackets each wanted rank, then one
aggregation counts what lies between the brackets and keeps only the values
inside them (about 0.2 % of a large group per quantile), and their ranks come
from running sums over slices of a bracket, so no task gets a whole group.
Groups of few rows get open brackets, which hold all their values; the picked
values and the arithmetic are the same for every bracket. Where a bracket missed
its rank, its group is done again with a wider one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.operators.ordered import running_sum
from stationflow.session import materialise

SKETCH_ACCURACY = 10_000
MARGIN = 0.001
OPEN_ROWS = 10_000
SLICES = 1_000


def _brackets(data: DataFrame, keys: list[str], inner: list[float], margin: float, open_rows: int) -> DataFrame:
    """Per key: row count, extremes, and an interval around each inner quantile.

    Groups of at most `open_rows` rows get open intervals; so do sides that reach
    past the extremes. NaN is above infinity, as in every order of Spark.
    """
    edges = [p - margin for p in inner] + [p + margin for p in inner]
    sketch = [F.percentile_approx("_x", [min(1.0, max(0.0, e)) for e in edges], SKETCH_ACCURACY).alias("_sketch")] if inner else []
    facts = data.groupBy(*keys).agg(F.count("_x").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"), *sketch)
    few = F.col("_n") <= open_rows
    lowest, highest = F.lit(float("-inf")), F.lit(float("nan"))
    columns = []
    for i, p in enumerate(inner):
        low = lowest if p <= margin else F.when(few, lowest).otherwise(F.col("_sketch")[i])
        high = highest if p >= 1 - margin else F.when(few, highest).otherwise(F.col("_sketch")[i + len(inner)])
        columns += [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]
    return facts.select(*[F.col(k).alias("_k_" + k) for k in keys], "_n", "_min", "_max", *columns)


def _slice_of(x: Column, count: int) -> tuple[Column, Column]:
    """Whether a value lies in no bracket, and a whole number rising with the
    value: slices of a bracket count up, what lies behind a bracket comes last."""
    inside, behind = [], F.lit(0)
    for i in range(count):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        width = high - low
        part = F.when((width > 0) & (width < float("inf")), F.floor((x - low) / width * (SLICES - 2))).otherwise(0)
        inside.append(F.when(x.between(low, high), part.cast("int") + i * SLICES))
        behind = behind + (high < x).cast("int")
    found = F.coalesce(*inside, F.lit(None).cast("int"))
    return found.isNull(), F.coalesce(found, behind * SLICES - 1)


def _same_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_k_" + k)) for k in keys])


def _neighbours(data: DataFrame, keys: list[str], inner: list[float], margin: float, open_rows: int) -> DataFrame:
    """Per key: row count, extremes, and for each inner quantile the values on both sides of its rank (`_a0`, `_b0`, ...)."""
    brackets = materialise(_brackets(data, keys, inner, margin, open_rows), "brackets")
    if keys:
        joined = data.join(brackets, _same_key(keys))
    else:
        joined = data.withColumn("_b", brackets.select(F.struct("*").alias("_b")).scalar()).select("_x", "_b.*")

    gap, place = _slice_of(F.col("_x"), len(inner))
    facts = ["_n", "_min", "_max"]
    counted = (
        joined.select(*keys, *facts, F.when(~gap, F.col("_x")).alias("_v"), place.alias("_slice"))
        .groupBy(*keys, *facts, "_slice", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranked = running_sum(counted, keys, ["_v"], F.col("_slice"), F.col("_c"), "_end")
    begin, end = F.col("_end") - F.col("_c"), F.col("_end")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((begin <= rank) & (rank < end), F.col("_v")))

    ranks = [F.lit(p) * (F.col("_n") - 1) for p in inner]
    picks = [value_at(F.floor(r)).alias(f"_a{i}") for i, r in enumerate(ranks)]
    picks += [value_at(F.ceil(r)).alias(f"_b{i}") for i, r in enumerate(ranks)]
    picked = ranked.groupBy(*keys, *facts).agg(*picks) if picks else ranked.select(*keys, *facts).distinct()
    if not inner or margin >= 1 or brackets.where(F.col("_n") > open_rows).isEmpty():
        return picked  # every bracket is open
    picked = materialise(picked, "picked")
    missed = reduce(lambda a, b: a | b, [F.col(f"_{side}{i}").isNull() for side in "ab" for i in range(len(inner))])
    rest = picked.where(missed)
    if rest.isEmpty():
        return picked
    again = data.join(rest.select(*[F.col(k).alias("_k_" + k) for k in keys]), _same_key(keys), "left_semi") if keys else data
    return picked.where(~missed).unionByName(_neighbours(again, keys, inner, margin * 10, open_rows))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
    open_rows: int = OPEN_ROWS, margin: float = MARGIN,
) -> DataFrame:
    """One row per key with a column per quantile; NULL values are left out.

    Counts and brackets are written first, one row per key: from their real size
    Catalyst decides whether they are broadcast, so that the data is not shuffled
    by key. `open_rows` and `margin` change the work, not the values.
    """
    keys = list(keys)
    inner = sorted({float(p) for p in probs if 0 < p < 1})
    data = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    picked = _neighbours(data, keys, inner, margin, open_rows)

    def column(p: float) -> Column:
        if not 0 < p < 1:
            return F.col("_min" if p <= 0 else "_max")
        i = inner.index(p)
        rank, below, above = F.lit(p) * (F.col("_n") - 1), F.col(f"_a{i}"), F.col(f"_b{i}")
        return below + (above - below) * (rank - F.floor(rank))

    return picked.select(*keys, *[column(float(p)).alias(name) for p, name in zip(probs, names)])
