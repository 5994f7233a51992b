"""N-gram Jaccard join: document classes by exact Jaccard links between word-shingle sets.

Documents are rows and n-grams columns of a sparse 0/1 matrix; a link is an entry
of matrix times transpose that is large enough for the two row sizes. The
product is never formed whole:

1. Columns are dealt by hash into blocks, a few more of them than two linked rows
   of these sizes can differ in places, so linked rows agree in some blocks whole.
   Rows that agree with others in fewer blocks than that are discarded before any product.
2. Rows that agree somewhere form groups. In groups of more than REGROUP_ROWS rows,
   counts of the columns inside the group discard further: linked rows share one
   of their rarest columns, as many as the size bound lets differ.
3. Groups of more than BLOCK_ROWS rows are cut into rings by distance from one row. Jaccard distance is a
   metric, so linked rows lie in one or neighbouring rings; the innermost ring is
   linked through its centre and needs no product at all.
4. The rest is multiplied in blocks of at most BLOCK_ROWS rows, columns in blocks
   too. Overlap counts accumulate, and a pair is discarded as soon as its count
   and what is left of both rows stay under the bound. A block gives a spanning
   forest of its links, not its pairs.

Sets are compared by 64-bit hashes of shingles; equal sets are one row from the
start. Nothing is capped: the steps only skip pairs that cannot link or whose
link changes no class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.llm.arrowtext import bounded_batches, buffers, chunks, mix, shingle_sets, strings
from stationflow.llm.components import connected_components
from stationflow.llm.hash_filter import split_by_keys
from stationflow.llm.names import free_names
from stationflow.session import materialise

BLOCK_ROWS = 256
REGROUP_ROWS = 8
BLOCK_COLUMNS = 4096
SEEDS = 4
NEED = 1 << 20
_U = np.uint64


def _sum_per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _set_ids(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, as signed numbers."""
    return mix(_sum_per_text(mix(tokens + _U(0x51ED270B)), counts) + counts.astype(_U)).view(np.int64)


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    offsets, data = buffers(texts)
    for lo, hi in chunks(offsets):
        tokens, counts = shingle_sets(offsets[lo : hi + 1], data, width)
        yield lo, hi, tokens, counts, _set_ids(tokens, counts)


def _summaries(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, _, counts, names in _sets(strings(batch.column(1)), width):
            kept = [c.slice(lo, hi - lo) for k, c in enumerate(batch.columns) if k != 1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(names)], names=[*[x for k, x in enumerate(batch.schema.names) if k != 1], "n_shingles", "sid"])


class Bounds:
    """What a similarity of `percent` / 100 means for set sizes."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def linked(self, overlap, a, b):
        return (100 + self.percent) * overlap >= self.percent * (a + b)

    def classes(self, largest: int) -> np.ndarray:
        """Lower ends of size classes: a set links within its own, the next and the last one only."""
        ends = [1]
        while ends[-1] <= largest * 2:
            ends.append(max(-(-ends[-1] * 13 // 10), -(-ends[-1] * 100 // self.percent), ends[-1] + 1))
        return np.array(ends)

    def differ(self, top: np.ndarray) -> np.ndarray:
        """The most members in which linked sets of at most `top` members can differ."""
        return 2 * top * (100 - self.percent) // (100 + self.percent)


def _signatures(tokens: np.ndarray, counts: np.ndarray, names: np.ndarray, bounds: Bounds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(block signature, set, dealing) of every set: sets that link have a signature in common.

    A set is signed for its own size class and, when a larger partner can lie in
    the next class, for that one. Empty blocks do not count: there are a few more
    blocks than needed, and a set with more empty blocks than that is signed
    again with another dealing of columns (two sets that agree in empty blocks only
    are both in that case). After the last dealing empty blocks are signed as well.
    A dealing is NEED times (size class and seed) plus the number of signatures that a
    set shares at least with whatever it links to.
    """
    if not len(counts):
        return
    ends = bounds.classes(int(counts.max()))
    own = np.searchsorted(ends, counts, "right") - 1
    starts = np.cumsum(counts) - counts
    for ahead in (0, 1):
        which = np.flatnonzero((counts > 0) & ((ahead == 0) | (100 * counts >= bounds.percent * ends[own + 1])))
        for seed in range(SEEDS):
            kind = own[which] + ahead
            most = bounds.differ(ends[kind + 1] - 1)
            which, kind, most = which[most > 0], kind[most > 0], most[most > 0]
            if not len(which):
                break
            spare = np.where(most >= 3, 1 + most * 3 // 20, 0)
            blocks = most + 1 + spare
            n = counts[which]
            base = np.cumsum(blocks) - blocks
            place = np.arange(n.sum()) + np.repeat(starts[which] - (np.cumsum(n) - n), n)
            mixed = mix(tokens[place] + _U(0xD1B54A32D192ED03 * (seed + 1) % (1 << 64)))
            block = ((mixed >> _U(32)) * np.repeat(blocks, n).astype(_U)) >> _U(32)
            at = np.repeat(base, n) + block.astype(np.int64)
            size = np.bincount(at, minlength=blocks.sum())
            sums = np.zeros(len(size), _U)
            np.add.at(sums, at, mixed)
            row = np.repeat(np.arange(len(which)), blocks)
            number = np.arange(len(size)) - base[row]
            sign = mix(sums + mix((number * 4096 + kind[row]).astype(_U) * _U(SEEDS) + _U(seed)))
            empty = np.bincount(row[size == 0], minlength=len(which))
            few = empty > spare
            last = seed == SEEDS - 1
            out = (size > 0) | (few[row] if last else False)
            need = np.where(few & last, 1 + spare, np.maximum(1 + spare - empty, 1))
            yield sign[out].view(np.int64), names[which][row[out]], ((kind * SEEDS + seed) * NEED + np.minimum(need, NEED - 1))[row[out]]
            which = which[few]


def _sign(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    bounds = Bounds(percent)
    for batch in batches:
        for _, _, tokens, counts, names in _sets(strings(batch.column(0)), width):
            _, first = np.unique(names, return_index=True)  # copies sign once
            if len(first) < len(names):
                keep = np.zeros(len(names), bool)
                keep[first] = True
                tokens, counts, names = tokens[np.repeat(keep, counts)], counts[keep], names[keep]
            for columns in _signatures(tokens, counts, names, bounds):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["sign", "sid", "dealing"])


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of signatures that more than one set has, once each, with the signature's first set; rows come ordered by signature and set."""
    names = ["sign", "sid", "dealing", "head"]
    sign = sid = None
    head, told = (0, 0), False  # the first set of the signature at hand and whether it was told
    for batch in batches:
        s, v, d = (batch.column(k).to_numpy() for k in (0, 1, 2))
        if not len(s):
            continue
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        new[0] = sign is None or s[0] != sign
        again = np.zeros(len(s), bool)
        again[1:] = ~new[1:] & (v[1:] == v[:-1])
        again[0] = not new[0] and v[0] == sid
        start = np.maximum.accumulate(np.where(new, np.arange(len(s)), -1))
        first, kind = np.where(start < 0, head[0], v[start]), np.where(start < 0, head[1], d[start])
        far = (first != v) & ~again
        begin = far.copy()  # the first differing row of a signature tells the head as well
        at = np.flatnonzero(far)
        begin[at[1:]] = start[at[1:]] != start[at[:-1]]
        if len(at) and start[at[0]] < 0 and told:
            begin[at[0]] = False
        if len(at):
            rows = [np.concatenate([s[far], s[begin]]), np.concatenate([v[far], first[begin]]), np.concatenate([d[far], kind[begin]]), np.concatenate([first[far], first[begin]])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=names)
        told = bool(far[start == start[-1]].any()) or (start[-1] < 0 and told)
        sign, sid, head = s[-1], v[-1], (first[-1], kind[-1])


def _shared(signs: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, component): sets (sid) that are joined through equal signatures (sign).

    In each round, sets that share fewer signatures with any others than a link needs are
    left out. A dealing of NEED or less asks for that many signatures.
    """
    dealt = lambda rows: rows.select("sign", "sid", "dealing").repartition("sign").sortWithinPartitions("sign", "sid").mapInArrow(_several, "sign long, sid long, dealing long, head long")
    rows = dealt(signs)
    rows = materialise(rows, "shared") if rounds else rows
    for k in range(rounds):
        enough = rows.groupBy("sid", "dealing").agg(F.count("*").alias("n")).filter(F.col("n") >= F.col("dealing") % NEED).drop("n")
        rows = dealt(rows.join(enough, ["sid", "dealing"]))
        rows = materialise(rows, "shared") if k < rounds - 1 else rows  # what the last round leaves is read once
    return connected_components(rows.select(F.col("sid").alias("a"), F.col("head").alias("b")))


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The shingles of the texts that stand for their set."""
    for batch in batches:
        wanted, group, size = (batch.column(k).to_numpy() for k in (1, 2, 3))
        for lo, hi, tokens, counts, names in _sets(strings(batch.column(0)), width):
            keep = names == wanted[lo:hi]
            ends = np.concatenate([[0], np.cumsum(counts[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[np.repeat(keep, counts)].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(group[lo:hi][keep]), pa.array(size[lo:hi][keep]), pa.array(counts[keep], pa.int64()), lists], names=["sid", "g", "size", "n", "grams"])


def _rarest(rows: DataFrame, percent: int) -> DataFrame:
    """Regroup rows of large groups by their rarest columns within the group."""
    grams = rows.select("g", "sid", "n", F.explode("grams").alias("gram"))
    common = grams.groupBy("g", "gram").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("df", "gram"))
    near = grams.join(common, ["g", "gram"]).withColumn("rank", rank)
    near = near.filter((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & (F.col("df") > 1))
    groups = _shared(near.select(F.xxhash64("g", "gram").alias("sign"), "sid", F.lit(1).cast("long").alias("dealing")), rounds=0)
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    named = groups.join(sizes, "component").select(F.col("node").alias("sid"), F.col("component").alias("g"), "size")
    return rows.select("sid", "n", "grams").join(named, "sid").select("sid", "g", "size", "n", "grams")


def _jobs(rows: DataFrame, percent: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Products to form (job, side, sid, n, grams), and the links to group centres found on the way (a, b)."""
    centre = rows.filter("sid = g").select("g", F.col("grams").alias("centre"), F.col("n").alias("m"))
    both = rows.join(centre, "g").withColumn("both", F.size(F.array_intersect("grams", "centre")).cast("long"))
    far = 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
    ring = F.when((100 + percent) * F.col("both") >= percent * (F.col("n") + F.col("m")), 0).otherwise(F.greatest(F.lit(1), F.floor(far / ((100.1 - percent) / 100)))).cast("long")
    ringed = materialise(both.select("g", "sid", "n", "grams", ring.alias("ring")), "rings")
    blocks = ringed.groupBy("g", "ring").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    near = lambda shift, name: blocks.select("g", (F.col("ring") + shift).alias("ring"), F.col("blocks").alias(name))
    at = ringed.join(near(0, "own"), ["g", "ring"]).join(near(-1, "above"), ["g", "ring"], "left").join(near(1, "below"), ["g", "ring"], "left")
    at = at.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "sid"), "own"))
    upto = lambda name, when: F.when(when & (F.col(name) > 0), F.sequence(F.lit(0), F.col(name) - 1)).otherwise(F.array().cast("array<long>"))
    job = lambda kind, low, i, j: F.xxhash64("g", F.lit(kind), low, i, j)
    one = lambda name, side: F.struct(name.alias("job"), side.cast("int").alias("side"))
    b, r = F.col("block"), F.col("ring")
    within = F.transform(upto("own", r > 0), lambda j: one(job("within", r, F.least(b, j), F.greatest(b, j)), F.when(j == b, 0).when(b < j, 1).otherwise(2)))
    outward = F.transform(upto("above", F.lit(True)), lambda j: one(job("between", r, b, j), F.lit(1)))
    inward = F.transform(upto("below", F.lit(True)), lambda j: one(job("between", r - 1, j, b), F.lit(2)))
    jobs = at.select(F.explode(F.concat(within, outward, inward)).alias("x"), "sid", "n", "grams").select("x.job", "x.side", "sid", "n", "grams")
    return jobs, ringed.filter("ring = 0 and sid <> g").select(F.col("sid").alias("a"), F.col("g").alias("b"))


def _product(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Which rows of `left` and `right` (numbers into `lists`) link, from overlaps summed block by block."""
    n = np.array([len(x) for x in lists])
    need = lambda: bounds.percent * (n[left][:, None] + n[right][None, :])
    flat = np.concatenate(lists)
    columns, where, common = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(lists)), n)
    shared = common[where] > 1
    row, where = row[shared], where[shared]
    column = np.cumsum(common > 1)[where] - 1
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    rest = np.bincount(row, minlength=len(lists))
    counts = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, BLOCK_COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + BLOCK_COLUMNS])
        block = np.zeros((len(lists), BLOCK_COLUMNS), np.float32)
        block[row[i:j], column[i:j] - lo] = 1
        counts += block[left] @ block[right].T
        rest = rest - np.bincount(row[i:j], minlength=len(lists))
        possible = counts + np.minimum(rest[left][:, None], rest[right][None, :])
        if not ((100 + bounds.percent) * possible.astype(np.int64) >= need()).any():
            return np.zeros(counts.shape, bool)
    return (100 + bounds.percent) * counts.astype(np.int64) >= need()


def _forest(ids: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what `pairs` (numbers into `ids`) connects, at most one per id."""
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        root = root[root]
        if (root == before).all():
            return [(int(ids[k]), int(ids[r])) for k, r in enumerate(root) if r != k]


def _multiply(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of every job; rows come ordered by job, and a job's rows are bounded by two row blocks."""
    bounds = Bounds(percent)

    def links(rows: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
        side = np.array([r[0] for r in rows])
        ids = np.array([r[1] for r in rows])
        lists = [r[2].view(_U) for r in rows]
        found = []
        for a, b in (((side == 0), (side == 0)), ((side == 1), (side == 2))):
            left, right = np.flatnonzero(a), np.flatnonzero(b)
            if len(left) and len(right):
                hit = np.argwhere(_product(lists, left, right, bounds))
                found.append(np.stack([left[hit[:, 0]], right[hit[:, 1]]], 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return _forest(ids, pairs) if len(pairs) else []

    held, key, out = [], None, []
    for batch in batches:
        jobs, sides, ids = (batch.column(k).to_numpy() for k in (0, 1, 2))
        grams = batch.column(3)
        values, ends = grams.values.to_numpy(), grams.offsets.to_numpy()
        for k in range(len(jobs)):
            if jobs[k] != key:
                out += links(held) if held else []
                held, key = [], jobs[k]
            held.append((sides[k], ids[k], values[ends[k] : ends[k + 1]].copy()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
            out = []
    if held and (out := links(held)):
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def link_classes(docs: DataFrame, words: int = 5, percent: int = 80, block_rows: int = BLOCK_ROWS, keys: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text).

    With `keys` (names and columns to carry) these and `class_id`, an arbitrary number
    of the class, follow; it is null for rows without a shingle.

    Two texts link when 100 * overlap >= `percent` * union of their sets of
    `words`-word shingles; component_id is the smallest doc_id reachable by
    links. Null and empty texts, and texts without words, have no shingle and
    link with nothing: their component is their own doc_id. Repeated rows each
    come back; a null doc_id is never a component's name unless it stands alone. An
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    keys = keys or {}
    digest = F.xxhash64("text")
    told = docs.select("doc_id", "text", *[c.alias(k) for k, c in keys.items()], digest.alias("_of_text"))
    docs = docs.select("doc_id", "text")
    carried = "".join(f"{k} {told.schema[k].dataType.simpleString()}, " for k in keys)
    sets = materialise(told.mapInArrow(partial(_summaries, width=words), f"doc_id long, {carried}_of_text long, n_shingles long, sid long"), "sets")
    groups = _shared(docs.select("text").mapInArrow(partial(_sign, width=words, percent=percent), "sign long, sid long, dealing long"))
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    # One row stands for each set, also where rows repeat, share a doc_id or have none.
    repeats = sets.filter("n_shingles > 0").groupBy("sid", "doc_id", "_of_text").agg(F.count("*").alias("repeats"))
    stands = repeats.groupBy("sid").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_of_text", "repeats")).alias("x")).select("sid", F.col("x.doc_id").alias("id"), "x._of_text", "x.repeats")
    wanted = groups.join(sizes, "component").select(F.col("node").alias("sid"), F.col("component").alias("g"), "size").join(stands, "sid")
    wanted = materialise(wanted.select("id", "_of_text", "sid", "g", "size", "repeats"), "wanted")
    stand = F.col("doc_id").eqNullSafe(F.col("id")) & (digest == F.col("_of_text"))
    likely, _ = split_by_keys(docs, digest, wanted.select("_of_text"))  # only texts that stand for a set meet the exchange, and few others
    found = likely.join(wanted.filter("repeats = 1").hint("shuffle_hash"), stand).select("text", "sid", "g", "size")
    if wanted.filter("repeats > 1").limit(1).count():
        again = likely.join(wanted.filter("repeats > 1"), stand).groupBy("sid", "g", "size").agg(F.any_value("text").alias("text"))
        found = found.unionByName(again)
    rows = found.mapInArrow(partial(_members, width=words), "sid long, g long, size long, n long, grams array<long>")
    rows = materialise(rows, "rows")
    small, large = rows.filter(F.col("size") <= REGROUP_ROWS), rows.filter(F.col("size") > REGROUP_ROWS)
    alone = lambda df: df.select(F.col("g").alias("job"), F.lit(0).alias("side"), "sid", "n", "grams")
    jobs, links = alone(small), spark.createDataFrame([], "a long, b long")
    if large.limit(1).count():
        large = materialise(_rarest(large, percent), "rows")
        cut, links = _jobs(large.filter(F.col("size") > block_rows), percent, block_rows)
        jobs = jobs.unionByName(alone(large.filter(F.col("size") <= block_rows))).unionByName(cut)
    dealt = jobs.select("job", "side", "sid", "grams").repartition("job").sortWithinPartitions("job")
    classes = connected_components(links.union(dealt.mapInArrow(partial(_multiply, percent=percent), "a long, b long")))
    named = sets.join(classes.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    named = materialise(named.select("doc_id", "n_shingles", *keys, "component"), "named")
    smallest = named.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = named.join(smallest, "component", "left")
    some = F.col("n_shingles") > 0
    out = joined.select("doc_id", "n_shingles", F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *keys, F.when(some, F.col("component")).alias("class_id"))
    return out if keys else out.drop("class_id")


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of every class: the one with the smallest doc_id (rows without one come last).

    Rows that share doc_id and text stay or go together; a document in no class stays. Columns may have any name and type.
    """
    rows = link_classes(docs, words, percent, keys={"_digest": F.xxhash64("text")}).filter("class_id is not null")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_digest")
    first = rows.groupBy("class_id").agg(F.min(place).alias("first"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min("_digest").alias("x"), F.max("_digest").alias("y"))
    several = first.filter("not (a <=> b) or x <> y or a is null").select("class_id", "first")  # classes of one document need no look at their rows
    gone = rows.join(several, "class_id").filter(place != F.col("first")).select("doc_id", "_digest").distinct()
    (helper,) = free_names(docs, "helper")
    gone = materialise(gone, "copies")
    maybe, stay = split_by_keys(docs, F.xxhash64("text"), gone.select("_digest"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{helper}.doc_id")) & (F.xxhash64("text") == F.col(f"{helper}._digest"))
    return stay.unionByName(maybe.join(gone.select(F.struct("doc_id", "_digest").alias(helper)), same, "left_anti"))
