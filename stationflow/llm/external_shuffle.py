"""Sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into buckets that fit in memory, by a seeded hash.
Pass 2 shuffles each bucket by itself (Fisher-Yates, Spark's `shuffle`). The
buckets one after the other are a random order of all records; equal runs of it
are the shards, so their row counts are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.session import materialise

BUCKET_BYTES = 32 << 20
SPAN = 1000


def _starts(counts: DataFrame) -> DataFrame:
    """(bucket, start): rows before each bucket, summed within runs of SPAN buckets and over the runs."""
    runs = counts.groupBy((F.col("bucket") / SPAN).cast("long").alias("run")).agg(F.sum("n").alias("m"))
    before = lambda value, w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = runs.select("run", before("m", Window.orderBy("run")).alias("base"))
    inner = counts.withColumn("run", (F.col("bucket") / SPAN).cast("long")).withColumn("inner", before("n", Window.partitionBy("run").orderBy("bucket")))
    return inner.join(base, "run").select("bucket", (F.col("base") + F.col("inner")).alias("start"))


def _scatter(records: DataFrame, shards: int, size: str, seed: int, bucket_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """(bucket, record) of every row, with `_copy` in the record; the start of each bucket; and how many rows there are.

    Only rows whose hash occurs again are grouped to number their copies; all others keep out of that shuffle.
    """
    columns = [f"`{c}`" for c in records.columns]
    digest = F.xxhash64(*columns)
    total, rows = records.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-int(total) // bucket_bytes), -(-shards // 4))
    several = materialise(records.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_digest"), "repeats")
    each = records.withColumn("_copy", F.lit(1).cast("long"))
    if several.limit(1).count():
        again = records.join(several, digest == F.col("_digest"), "left_semi").groupBy(*columns).agg(F.count("*").alias("_copies"))
        again = again.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copies")
        each = each.join(several, digest == F.col("_digest"), "left_anti").unionByName(again)
    bucket = F.pmod(F.xxhash64(F.lit(seed), *columns, "_copy"), F.lit(buckets)).alias("bucket")
    start = materialise(_starts(each.select(bucket).groupBy("bucket").agg(F.count("*").alias("n"))), "starts")
    return each.select(bucket, F.struct("_copy", *columns).alias("record")), start, int(rows)


def _mixed(scattered: DataFrame, seed: int) -> DataFrame:
    """(bucket, at, record): every bucket in random order."""
    whole = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list("record")).alias("records"))
    return whole.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("at", "record"))


def _placed(mixed: DataFrame, start: DataFrame, rows: int, shards: int) -> DataFrame:
    """The records with shard and slot."""
    place = mixed.join(start, "bucket").withColumn("place", F.col("start") + F.col("at"))
    placed = place.withColumn("shard", F.expr(f"place * {shards} div {max(rows, 1)}"))
    first = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return placed.select("record.*", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot")).drop("_copy")


def _kept(records: DataFrame) -> DataFrame:
    return records.select(*[f"`{c}`" for c in records.columns if c.lower() not in ("shard", "slot")])


def shuffled_shards(records: DataFrame, shards: int, size: str, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """`records` with shard (0 to `shards` - 1) and slot (0, 1, ... within the shard), in random order.

    `size` names the column with a record's bytes; it sets the number of buckets.
    Records may hold nulls anywhere and may repeat: repeats are counted first and
    then scattered one by one, so a record that holds a third of all rows fills no
    bucket. Columns named shard or slot give way. An empty table gives an empty
    result. The permutation is fixed by its written table, so a lost executor
    cannot mix two orders.
    """
    scattered, start, rows = _scatter(_kept(records), shards, size, seed, bucket_bytes)
    return _placed(materialise(_mixed(scattered, seed), "shuffled"), start, rows, shards)


def write_shards(records: DataFrame, path: str, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write whole records below `path`, one folder per shard, each shard's files in slot order; gives the written table."""
    size = F.lit(0)
    for c, kind in records.dtypes:
        size = size + (F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    sized = records.withColumn("_bytes", size.cast("long"))
    scattered, start, rows = _scatter(_kept(sized), shards, "_bytes", seed, bucket_bytes)
    # Neighbouring buckets share a task, so the texts cross the network once and files are in slot order.
    placed = _placed(_mixed(scattered.repartitionByRange("bucket"), seed), start, rows, shards).drop("_bytes")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return records.sparkSession.read.parquet(path)
