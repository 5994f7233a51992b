"""Ranked search over impact vectors, pruned by their lengths.

A document is a vector of impacts: for each query term what it would add to the
score. Vectors are put in order by length and cut into buckets of neighbours. A
query asks the buckets from the longest vectors down and keeps the score of its k-th best so far:

* Cauchy-Schwarz: no vector of a bucket scores more than the bucket's longest vector times
  the length of the query, so a bucket below the k-th best is passed over.
* Coordinate bounds: a bucket knows the largest impact of each term. The
  terms with the smallest ones are set aside as long as their largest impacts together stay below the k-th best; a
  document without any other term cannot reach it. What the other terms give is added up, and a document stays
  only if that and a bound for the rest (the smaller one of the largest impacts and of Cauchy-Schwarz on what is left of its vector) reach the k-th best.
* What stays is scored again in whole numbers.

Bounds are raised by a margin for rounding, so the results are exact. Queries are
taken in blocks, so that what tasks hold is bounded; each task returns at most k
rows for each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from stationflow.llm.arrowtext import CHUNK_BYTES, bounded_batches, buffers, chunks, give_back, strings
from stationflow.llm.terms import batch_terms
from stationflow.session import materialise

BLOCK_BYTES = 4 << 20
BUCKET_ROWS = 2048
SEED_ROWS = 8192
CLASSES = 64
MARGIN = 1 + 1e-9


@dataclass(frozen=True)
class Queries:
    """A block of queries: their terms as numbers of a vocabulary, of which only it and they are held."""

    ids: list[int | None]
    terms: list[np.ndarray]
    vocabulary: list[bytes]

    @staticmethod
    def of(rows: list) -> "Queries":
        words, index, counts = batch_terms(pa.array([r[1] or "" for r in rows], pa.string()))
        ends = np.cumsum(counts)
        return Queries([r[0] for r in rows], [np.unique(index[e - n : e]) for e, n in zip(ends, counts, strict=True)], words.to_pylist())


# --- the index -----------------------------------------------------------------------------
def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(doc_id, length in terms, vocabulary terms as numbers, their occurrences) of every text with a term."""
    known = pa.array(vocabulary, pa.binary())
    for batch in batches:
        texts = strings(batch.column(1))
        for lo, hi in chunks(buffers(texts)[0], CHUNK_BYTES):
            words, index, counts = batch_terms(texts.slice(lo, hi - lo))
            number = pc.fill_null(pc.index_in(words, known), -1).to_numpy().astype(np.int64)
            term, row = number[index], np.repeat(np.arange(hi - lo), counts)
            pair, tf = np.unique((row * len(vocabulary) + term)[term >= 0], return_counts=True)
            row, term = pair // max(len(vocabulary), 1), pair % max(len(vocabulary), 1)
            at = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (term, tf)]
            made = pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts), *lists], names=["doc_id", "n", "terms", "tfs"])
            yield made.filter(pa.array(counts > 0))
            give_back()


def _frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])


def _weights(index: DataFrame, size: int, documents: int) -> np.ndarray:
    """Each vocabulary term's weight; a task hands on at most one number a term."""
    found = index.select("terms").mapInArrow(partial(_frequencies, size=size), "term long, df long").groupBy("term").agg(F.sum("df"))
    df = np.zeros(size, np.int64)
    for term, n in found.collect():  # as many rows as the block has terms
        df[term] = n
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _parts(batch: pa.RecordBatch, weights: np.ndarray, total: int, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the rows, terms, impacts) of a batch with columns n, terms and tfs, in whole numbers."""
    n, terms, tfs = (batch.column(batch.schema.get_field_index(c)) for c in ("n", "terms", "tfs"))
    sizes = pc.list_value_length(terms).to_numpy().astype(np.int64)
    term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
    m = np.array([10 + 90 * int(x) * documents // total for x in n.to_pylist()], np.int64)
    impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)))
    return np.concatenate([[0], np.cumsum(sizes)]), term, impact


def _lengths(batches: Iterator[pa.RecordBatch], weights: np.ndarray, total: int, documents: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, _, impact = _parts(batch, weights, total, documents)
        length = np.sqrt(np.add.reduceat(impact.astype(float) ** 2, at[:-1])) if len(at) > 1 else np.zeros(0)  # every row has a term
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length, pa.float64())], names=[*batch.schema.names, "length"])


# --- the search ----------------------------------------------------------------------------
class Bucket:
    """Vectors of about the same length, by document and by term."""

    def __init__(self, ids: list, lengths: np.ndarray, at: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        self.ids, self.lengths, self.at, self.term, self.impact = ids, lengths, at, term, impact
        row = np.repeat(np.arange(len(ids)), np.diff(at))
        order = np.argsort(term, kind="stable")
        self.by_term, self.row, self.value = term[order], row[order], impact[order].astype(float)
        self.heads = np.flatnonzero(np.append(True, self.by_term[1:] != self.by_term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.held = self.by_term[self.heads]
        self.most = np.maximum.reduceat(self.value, self.heads) if len(term) else np.zeros(0)
        self.tails = np.append(self.heads[1:], len(self.by_term))

    def candidates(self, query: np.ndarray, floor: float) -> np.ndarray:
        """Rows that may score `floor` or more (and above 0) for the terms of `query`."""
        none = np.zeros(0, np.int64)
        if math.sqrt(len(query)) * self.lengths.max(initial=0.0) * MARGIN < max(floor, 1.0):
            return none
        where = np.searchsorted(self.held, query)
        where = where[(where < len(self.held)) & (self.held[np.minimum(where, len(self.held) - 1)] == query)] if len(self.held) else none
        most = self.most[where]
        order = np.argsort(most, kind="stable")
        where, most = where[order], most[order]
        below = np.cumsum(most)
        aside = int(np.searchsorted(below * MARGIN, max(floor, 1.0), "left"))
        if aside == len(where):
            return none
        lists = [slice(a, b) for a, b in zip(self.heads[where[aside:]], self.tails[where[aside:]], strict=True)]
        rows, values = (np.concatenate([x[s] for s in lists]) for x in (self.row, self.value))
        seen = np.bincount(rows, values, len(self.ids))
        squares = np.bincount(rows, values * values, len(self.ids))
        left = np.sqrt(np.maximum(self.lengths**2 * MARGIN - squares, 0.0))
        rest = np.minimum(below[aside - 1] if aside else 0.0, math.sqrt(aside) * left)
        return np.flatnonzero((seen > 0) & ((seen + rest) * MARGIN >= floor))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of `rows`."""
        sizes = self.at[rows + 1] - self.at[rows]
        place = np.arange(sizes.sum()) + np.repeat(self.at[rows] - np.cumsum(sizes) + sizes, sizes)
        term = self.term[place]
        at = np.minimum(np.searchsorted(query, term), len(query) - 1)
        hit = query[at] == term
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, np.repeat(np.arange(len(rows)), sizes)[hit], self.impact[place][hit])
        return out


def _search(batches: Iterator[pa.RecordBatch], queries: Queries, weights: np.ndarray, total: int, documents: int, k: int, floors: np.ndarray, rows: int) -> Iterator[pa.RecordBatch]:
    """The task's k best of each query that reach its floor, from rows in order of falling length."""
    best: list[list[tuple[int, int | None]]] = [[] for _ in queries.ids]
    floors = floors.copy()
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for whole in batches:
        for lo in range(0, whole.num_rows, rows):
            batch = whole.slice(lo, rows)
            ids, lengths = batch.column(0).to_pylist(), batch.column(batch.schema.get_field_index("length")).to_numpy()
            bucket = Bucket(ids, lengths, *_parts(batch, weights, total, documents))
            for q, terms in enumerate(queries.terms):
                found = bucket.candidates(terms, floors[q])
                if not len(found):
                    continue
                scores = bucket.scores(found, terms)
                if len(found) > k:
                    least = np.partition(scores, len(scores) - k)[len(scores) - k]
                    found, scores = found[scores >= least], scores[scores >= least]
                reached = [(int(s), ids[r]) for r, s in zip(found, scores, strict=True) if s >= max(floors[q], 1)]
                if reached:
                    best[q] = sorted(best[q] + reached, key=key)[:k]
                    if len(best[q]) == k:
                        floors[q] = max(floors[q], best[q][-1][0])
        give_back()
    flat = [(q, s, d) for q, found in enumerate(best) for s, d in found]
    columns = list(zip(*flat, strict=True)) if flat else [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "score", "doc_id"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(texts: DataFrame, queries: Queries, k: int, bucket_rows: int, seed_rows: int) -> DataFrame:
    """(query, rank, doc_id, score) for one block; `query` is its place in the block."""
    size = len(queries.vocabulary)
    vectors = texts.mapInArrow(partial(_vectors, vocabulary=queries.vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>")
    vectors = materialise(vectors, "terms")
    documents, total = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = _weights(vectors, size, documents)
    numbers = {"weights": weights, "total": max(total, 1), "documents": documents}
    length = vectors.filter(F.size("terms") > 0).mapInArrow(partial(_lengths, **numbers), "doc_id long, n long, terms array<int>, tfs array<int>, length double")
    # Copies have one length: a hash of the id deals them over tasks.
    ordered = length.repartitionByRange(F.desc("length"), F.xxhash64("doc_id")).sortWithinPartitions(F.desc("length"))
    index = materialise(ordered, "impacts")
    search = partial(_search, queries=queries, k=k, rows=bucket_rows, **numbers)
    schema = "query long, score long, doc_id long"
    # The longest vectors first, for a floor that every task starts from: all in the length classes that hold the first `seed_rows`.
    classes = index.filter("length > 0").groupBy(F.floor(F.log2("length") * CLASSES).alias("class")).agg(F.count("*").alias("n"))
    held, least = 0, 0.0
    for c, n in sorted(classes.collect(), reverse=True):  # a class for each CLASSES-th of a doubling: at most some thousand
        held, least = held + n, 2.0 ** (c / CLASSES)
        if held >= seed_rows:
            break
    longest = index.filter(F.col("length") >= least / MARGIN)
    floors = np.zeros(len(queries.ids))
    for q, n, score in _best(longest.mapInArrow(partial(search, floors=floors), schema), k).groupBy("query").agg(F.count("*"), F.min("score")).collect():  # one row a query of the block
        floors[q] = score if n == k else 0
    return _best(index.mapInArrow(partial(search, floors=floors), schema), k)


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents with score above 0 for each row of `items` (item_id, text).

    Terms are the longest runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased, of
    whole texts of `docs` (doc_id, text). Scores are sums of term weight times saturated term
    frequency in whole numbers; equal scores go by ascending doc_id, a null id last. Null and empty texts have no
    terms: such a document is in no result and not counted, such an item has no rows. Repeated
    rows are documents, and items, of their own. Other columns are ignored; empty tables give an empty result.

    Items come to the driver in blocks of about `block_bytes` of text (an item longer than that is a block
    with few others), and every block is one search over all documents.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = materialise(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).filter("text <> ''"), "items")
    blocks = int(asked.agg(F.ceil(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) / block_bytes)).first()[0])
    found = [spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about `block_bytes`
        if not rows:
            continue
        queries = Queries.of(rows)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "query long, item_id long")
        result = _search_block(texts, queries, k, bucket_rows, seed_rows).join(names, "query")
        found.append(materialise(result.select("item_id", "rank", "doc_id", "score"), "ranked"))
    return reduce(DataFrame.unionByName, found)
