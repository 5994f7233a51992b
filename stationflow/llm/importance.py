"""Importance resampling towards a target distribution, with bit-sliced aggregation.

Features are runs of words, hashed into buckets. A bucket's gain is the rounded log ratio
of its share in the target and in the corpus. A document's counts become bit
planes over the buckets: plane j has the bits j of all its counts. The gains become
signed bit planes as well, in two's complement. The sum of the gains over a document's features
is then exact: AND a count plane with a gain plane, count the bits, and add the
counts times powers of two.

The draw adds Gumbel noise from a hash of the id to the mean gain and keeps the
highest sums, which is sampling without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField

from stationflow.llm.arrowtext import CHUNK_BYTES, bounded_batches, buffers, chunks, give_back, strings, with_columns
from stationflow.llm.terms import batch_terms
from stationflow.session import materialise

BUCKETS = 10_000


def _features(texts: pa.Array, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, features of each text, words of each text), text after text."""
    terms, index, words = batch_terms(texts)
    if width == 1:
        hashed = np.array([zlib.crc32(t) for t in terms.to_pylist()], np.int64) % buckets
        return hashed[index], words, words
    spelled, out, sizes, at = terms.to_pylist(), [], [], 0
    for n in words.tolist():
        run = [spelled[i] for i in index[at : at + n]]
        at += n
        found = [zlib.crc32(b" ".join(run[k : k + w])) % buckets for w in range(1, width + 1) for k in range(n - w + 1)]
        out += found
        sizes.append(len(found))
    return np.array(out, np.int64), np.array(sizes, np.int64), words


def _totals(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        texts = strings(batch.column(0))
        for lo, hi in chunks(buffers(texts)[0]):
            total += np.bincount(_features(texts.slice(lo, hi - lo), width, buckets)[0], minlength=buckets)
        give_back()
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, width: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of each bucket over all rows of `texts` (text): one number a bucket reaches the driver.

    Every task adds up its own rows first and hands on at most `buckets` sums.
    """
    bounded_batches(texts.sparkSession)
    found = texts.select("text").mapInArrow(partial(_totals, width=width, buckets=buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths: the log ratio of its smoothed shares, rounded down."""
    buckets, t, s = len(target), float(target.sum()), float(corpus.sum())
    ratio = lambda a, b: ((float(a) + 1) * (s + buckets)) / ((float(b) + 1) * (t + buckets))
    return np.array([math.floor(1000 * math.log(ratio(a, b))) for a, b in zip(target, corpus, strict=True)], np.int64)


class GainPlanes:
    """Gains as bit planes over the buckets, in machine words of 64 buckets; the last plane is the sign and counts negative."""

    def __init__(self, gain: np.ndarray) -> None:
        self.words = -(-len(gain) // 64)
        planes = int(max(np.abs(gain).max(initial=0), 1)).bit_length() + 1
        padded = np.zeros(self.words * 64, np.int64)
        padded[: len(gain)] = gain
        place = np.arange(64, dtype=np.uint64)
        bits = ((padded[None, :] >> np.arange(planes)[:, None]) & 1).astype(np.uint64).reshape(planes, self.words, 64)
        self.planes = np.bitwise_or.reduce(bits << place, axis=2)
        self.worth = np.array([1 << k for k in range(planes)], np.int64)
        self.worth[-1] = -self.worth[-1]

    def sums(self, bucket: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The exact sum of gains of each text, from the buckets of its features.

        Only machine words with a bit are held, so a short text costs as many words as it has features at most.
        """
        out = np.zeros(len(sizes), np.int64)
        if not len(bucket):
            return out
        span = self.words * 64
        cell, count = np.unique(np.repeat(np.arange(len(sizes)), sizes) * span + bucket, return_counts=True)
        line = cell >> 6  # text and machine word together
        head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        bit = np.uint64(1) << (cell & 63).astype(np.uint64)
        text, word = line[head] // self.words, line[head] % self.words
        total = np.zeros(len(head), np.int64)
        for j in range(int(count.max()).bit_length()):
            plane = np.bitwise_or.reduceat(np.where((count >> j) & 1, bit, np.uint64(0)), head)
            some = np.flatnonzero(plane)
            ours, where = plane[some], word[some]
            for gain, worth in zip(self.planes, self.worth, strict=True):
                total[some] += np.bitwise_count(ours & gain[where]).astype(np.int64) * (int(worth) << j)
        starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[starts]] = np.add.reduceat(total, starts)
        return out


def importance_weights(docs: DataFrame, gain: np.ndarray, width: int = 1, text: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_features` and `weight`: the mean gain over a document's features, rounded down.

    Null and empty texts have no features and weight 0. Columns of the same names
    give way; rows stay one for one.
    """
    planes, buckets = GainPlanes(gain), len(gain)

    def add(batch: pa.RecordBatch) -> list[pa.Array]:
        values = strings(batch.column(batch.schema.get_field_index(text)))
        parts = []
        for lo, hi in chunks(buffers(values)[0]):
            bucket, sizes, words = _features(values.slice(lo, hi - lo), width, buckets)
            parts.append((words, sizes, planes.sums(bucket, sizes) // np.maximum(sizes, 1)))
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3)]
        return [pa.array(c, pa.int64()) for c in columns]

    return with_columns(docs, [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")], add, text, CHUNK_BYTES)


def gumbel_noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of seed and id; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw_highest(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """`scored` (doc_id, score and any columns that can be grouped by) with `rank`: 1, 2, 3... by falling score, ties by doc_id.

    Of the N rows for which `eligible` holds the floor(percent * N / 100) highest get a rank,
    the others null. Scores are whole numbers in a range that does not grow with the
    rows, so counts per score tell which scores are drawn, and only rows of the same score are put
    in order. Ties of score and id go by the other columns; repeated rows get a rank each. A null id comes last.
    """
    given = scored.columns
    scored = materialise(scored.withColumn("_eligible", F.coalesce(eligible, F.lit(False))), "scored")
    able = scored.filter("_eligible")
    counts = able.groupBy("score").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # one row a score
    counts = materialise(counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))), "scores")
    drawn = able.count() * percent // 100
    first = counts.filter(F.col("_before") < drawn).select(F.col("score").alias("_score"), "_before")
    known = scored.join(first, F.col("_eligible") & (F.col("score") == F.col("_score")), "left").drop("_score", "_eligible")
    # Rows that repeat are one row with a count, so a row that fills the table is ordered once.
    some = known.filter("_before is not null").groupBy(*[f"`{c}`" for c in given], "_before").agg(F.count("*").alias("_n"))
    others = [f"`{c}`" for c in given if c not in ("doc_id", "score")]
    earlier = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), *others).rowsBetween(Window.unboundedPreceding, -1)
    placed = some.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    each = placed.withColumn("_at", F.explode(F.sequence(F.col("_at") + 1, F.col("_at") + F.col("_n"))))
    ranked = each.withColumn("rank", F.when(F.col("_at") <= drawn, F.col("_at")))
    rest = known.filter("_before is null").withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*given, "rank").unionByName(rest.select(*given, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int, least_words: int = 20, seed: int = 0, width: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs` (doc_id, text), drawn towards the texts of `target` (text).

    Words are the longest runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. Features are all runs of 1 to
    `width` words. Null and empty texts have none: weight 0, never drawn while `least_words`
    is above 0. An empty table gives an empty result, an empty target equal smoothed shares; other columns
    are ignored.
    """
    gain = gains(bucket_counts(target, width, buckets), bucket_counts(docs, width, buckets))
    weighed = importance_weights(docs.select("doc_id", "text"), gain, width)
    scored = weighed.select("doc_id", "n_features", "weight", (F.col("weight") + gumbel_noise(F.col("doc_id"), seed)).alias("score"), "n_words")
    return draw_highest(scored, F.col("n_words") >= least_words, percent).drop("n_words")
