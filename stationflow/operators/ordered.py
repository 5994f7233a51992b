"""Order-dependent work on keys of any size.

A window over a whole key sorts that key in one task. One key may hold a large
share of all rows, so the helpers here first count rows per (key, time bucket),
turn the counts into starting positions on that small table, and then need
windows over single buckets or fixed-size chunks only. Nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_ROWS = 50_000


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, weight: Column,
    name: str, total: str | None = None,
) -> DataFrame:
    """Add the running sum of `weight` inside each key, this row included.

    `bucket` must rise with `order`. `total` names an optional column with the
    key's sum. What lies before a bucket travels as one extra row into the
    bucket's group, so the rows themselves are shuffled once, by (key, bucket).
    """
    tagged = df.withColumns({"_bucket": bucket, "_w": weight.cast("long")})
    key_window = Window.partitionBy(*keys)
    earlier = key_window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        tagged.groupBy(*keys, "_bucket")
        .agg(F.sum("_w").alias("_w"))
        .select(
            *keys, "_bucket",
            F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_w"),
            F.sum("_w").over(key_window).alias("_total"),
            F.lit(1).alias("_is_head"),
        )
    )
    both = tagged.withColumn("_is_head", F.lit(0)).unionByName(heads, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(F.desc("_is_head"), *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    columns = {name: F.sum("_w").over(so_far)} | ({total: F.first("_total").over(so_far)} if total else {})
    return both.withColumns(columns).where("_is_head = 0").select(*df.columns, *columns)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "_row", total: str | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based position of each row inside its key in time order, and
    optionally the key's row count. Buckets are days."""
    return running_sum(df, keys, [order, *ties], F.col(order).cast("date"), F.lit(1), name, total)


def in_chunks(
    df: DataFrame, keys: Sequence[str], order: str, before: int = 0, after: int = 0,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Cut every key into chunks of `chunk_rows` consecutive rows with overlap.

    Each chunk also gets the last `before` rows of the chunk ahead of it and the
    first `after` rows of the next, marked `_own = false`. A window over
    (keys, `_chunk`) ordered by `_row` whose frame reaches no further than that
    gives the same values as one over the whole key; keep `_own` rows afterwards.
    """
    if chunk_rows < max(before, after, 1):
        raise ValueError("chunk_rows must be at least as long as the overlap")
    numbered = number_rows(df, keys, order)
    at = F.col("_row") - 1
    chunk, place = F.floor(at / chunk_rows), at % chunk_rows
    homes = [F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))]
    if before:
        homes.append(F.when(place >= chunk_rows - before, F.struct((chunk + 1).alias("chunk"), F.lit(False).alias("own"))))
    if after:
        homes.append(F.when(place < after, F.struct((chunk - 1).alias("chunk"), F.lit(False).alias("own"))))
    return (
        numbered.withColumn("_home", F.explode(F.array_compact(F.array(*homes))))
        .withColumn("_chunk", F.col("_home.chunk"))
        .withColumn("_own", F.col("_home.own"))
        .drop("_home")
    )
