"""Exact deduplication with heavy hitters split off.

Every text's SHA-256 is written once. Misra-Gries summaries of the digests, one per
task and merged in two levels, name at most COUNTERS candidates, among them every digest that
more than 1 / (COUNTERS + 1) of the rows have. An exact count verifies them; the
winners of the frequent ones, a table of at most COUNTERS rows, go to every task, so
copies of frequent texts are settled where they are read, before any exchange; only
rows with a winning doc_id are still counted. The other digests
take an ordinary shuffle in which no key is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stationflow.llm.arrowtext import bounded_batches
from stationflow.llm.hash_filter import split_by_keys
from stationflow.llm.names import free_names
from stationflow.session import materialise

COUNTERS = 1000
MERGERS = 64


def _trim(keys: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """A mergeable summary: subtract the count of the first key too many from all, keep what is left."""
    if len(keys) > counters:
        counts = counts - np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _summary(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        k, w = (np.concatenate([x, batch.column(i).to_numpy()]) for i, x in ((0, keys), (1, counts)))
        keys, where = np.unique(k, return_inverse=True)
        keys, counts = _trim(keys, np.bincount(where, weights=w, minlength=len(keys)).astype(np.int64), counters)
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "weight"])


def frequent(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(key, weight) candidates for frequent values of the long column `key`: at most `counters` rows.

    A key with more than 1 / (`counters` + 1) of the rows is always among them;
    weights are lower bounds.
    """
    bounded_batches(keys.sparkSession)
    schema, step = "key long, weight long", partial(_summary, counters=counters)
    first = keys.select("key", F.lit(1).cast("long").alias("weight")).mapInArrow(step, schema)
    # Each summary goes whole to one of MERGERS tasks, and theirs to the last one: bounded rows at either step.
    some = first.withColumn("part", F.spark_partition_id() % MERGERS).repartition(MERGERS, "part").select("key", "weight").mapInArrow(step, schema)
    return some.coalesce(1).mapInArrow(step, schema)


def _digest():
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))


def frequent_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of every digest that more than 1 / (`counters` + 1) of `rows` (doc_id, digest, key) have: at most `counters` rows."""
    candidates = materialise(frequent(rows.select("key"), counters), "candidates").select("key")
    group = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    counted = rows.join(F.broadcast(candidates), "key", "left_semi").groupBy("digest").agg(*group)  # broadcast: at most `counters` keys
    counted = materialise(counted, "counted")
    return materialise(counted.filter(F.col("group_size") > F.lit(rows.count()) / (counters + 1)), "winners")


def _groups(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, n, frequent): rows of written `rows` with their group.

    Rows of frequent digests are settled where they are read, each with n 1, but for those with the winning
    doc_id: these, and the rows of the other digests, are one row with their number n for each doc_id and digest.
    """
    known = F.broadcast(winners)  # at most `counters` rows
    heavy = rows.select("doc_id", "digest").join(known, "digest").select("doc_id", "digest", "keep_id", "group_size")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    one, many = F.lit(1).cast("long").alias("n"), F.count("*").alias("n")
    losers = heavy.filter(~wins).select("*", one)
    first = heavy.filter(wins).groupBy("doc_id", "digest", "keep_id", "group_size").agg(many)
    light = rows.select("doc_id", "digest").join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = light.groupBy("digest", "doc_id").agg(many)
    sizes = light.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    rest = light.join(sizes, "digest").select(first.columns)
    settled = losers.unionByName(first).withColumn("frequent", F.lit(True))
    return settled.unionByName(rest.withColumn("frequent", F.lit(False)))


def _digests(docs: DataFrame) -> DataFrame:
    return materialise(docs.select("doc_id", _digest().alias("digest")).withColumn("key", F.xxhash64("digest")), "digests")


def duplicate_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of `docs` (doc_id, text).

    Texts are equal when identical; null counts as empty. The row with the
    largest doc_id of a group stays (a null doc_id stays only where the group has no other); of
    repeated rows with that doc_id one stays. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = _digests(docs)
    found = _groups(rows, frequent_winners(rows, counters))
    copies = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return copies.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """`docs` with one row of every group of equal texts: the one with the largest doc_id.

    Copies of frequent texts are left out where they are read, against the broadcast winners, so their texts
    meet no exchange. Nor do texts without a copy, but for the few that a bitmap of the copies does not rule out. Of repeated rows with the largest doc_id the smallest by the other columns stays (maps
    compare as JSON). Columns may have any name and type.
    """
    rows = _digests(docs)
    winners = frequent_winners(rows, counters)
    helper, row = free_names(docs, "helper", "row")
    columns = [f"`{c}`" for c in docs.columns]
    wins = F.col("doc_id").eqNullSafe(F.col(f"{helper}.keep_id"))
    nested = lambda df, *names: df.select(F.struct(*names).alias(helper))
    at_scan = docs.join(F.broadcast(nested(winners, "digest", "keep_id")), _digest() == F.col(f"{helper}.digest"), "left")  # at most `counters` rows
    left = at_scan.filter(F.col(helper).isNull() | wins).select(*columns)
    groups = _groups(rows, winners)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    marked = materialise(groups.filter((~F.col("frequent") & ~stays) | (stays & (F.col("n") > 1))).select("doc_id", "digest", stays.alias("stays"), F.xxhash64("digest").alias("key")), "marked")
    same = F.col("doc_id").eqNullSafe(F.col(f"{helper}.doc_id")) & (_digest() == F.col(f"{helper}.digest"))
    left, single = split_by_keys(left, F.xxhash64(_digest()), marked.select("key"))
    once = single.unionByName(left.join(nested(marked, "doc_id", "digest"), same, "left_anti"))
    repeated = marked.filter("stays")
    if not repeated.limit(1).count():
        return once
    flat = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    maps = [f"`{c}`" for c, kind in docs.dtypes if "map<" in kind or kind == "variant"]
    place = F.struct(*flat, *([F.to_json(F.struct(*maps))] if maps else []))
    again = left.join(nested(repeated, "doc_id", "digest"), same).select(F.struct(*columns).alias(row), place.alias(helper), F.col("doc_id"), _digest().alias("digest"))
    first = again.groupBy("doc_id", "digest").agg(F.min_by(row, helper).alias(row))
    return once.unionByName(first.select(*[F.col(f"{row}.{c}") for c in columns]))
