"""Rows whose key may stand in another table, told where they are read by a bitmap of hashed keys.

A join that keeps or drops few rows of a table of texts would send every text through
an exchange. The bitmap is small enough to go to every task, so rows that it rules out
never meet the join; the few that it does not are joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.names import free_names
from stationflow.session import materialise

BITS_PER_KEY = 16
#: 16 MB. A longer list of keys makes the bitmap fuller, so that more rows meet the join; it never loses one.
MOST_BITS = 1 << 27
_MAP_BITS = 1 << 15  # of a bitmap of Spark's


def split_by_keys(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`df`'s rows whose long `key` may be in `keys`, the other rows): together every row of `df` once.

    `keys` is a written table of one long column. None of the other rows' keys is in it; a null is in no table.
    """
    (name,) = keys.columns
    helper, held = free_names(df, "helper", "held")
    bits = min(MOST_BITS, _MAP_BITS * (keys.count() * BITS_PER_KEY // _MAP_BITS + 1))
    at = lambda x: F.pmod(x, F.lit(bits).cast("long")) + 1
    place = keys.select(at(F.col(name)).alias("at")).filter("at is not null")
    maps = place.groupBy(F.bitmap_bucket_number("at").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    maps = materialise(maps, "bitmap").select(F.struct("number", "map").alias(held))
    told = df.select("*", at(key).alias(helper))
    told = told.join(F.broadcast(maps), F.bitmap_bucket_number(helper) == F.col(f"{held}.number"), "left")  # broadcast: at most MOST_BITS
    bit = F.bitmap_bit_position(helper)
    byte = F.conv(F.hex(F.substring(F.col(f"{held}.map"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1, F.lit(False))
    columns = [f"`{c}`" for c in df.columns]
    return told.filter(maybe).select(*columns), told.filter(~maybe).select(*columns)
