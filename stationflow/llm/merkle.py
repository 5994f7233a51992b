"""Document fingerprints: a Merkle tree over paragraphs and sections, as text.

The leaves are hashes of paragraphs (a line with its line end; a longer one in
pieces of at most PIECE code points), so that the leaves in order stand for the
whole text. A leaf whose hash ends in 0 closes a section: the borders come from
content, and an edit moves only the borders beside it. A section's hash covers its leaves, the root the
sections. A fingerprint reads

    <root>;<section> <leaf> <leaf> ...;<section> <leaf> ...

Equal roots mean equal texts; where roots differ, sections and then leaves tell
where. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.session import materialise

PIECE = 96
LEAF, SECTION = 16, 8


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def fingerprint(text: Column, piece: int = PIECE) -> Column:
    """The fingerprint of a text; null counts as empty, whose tree has a root only."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^\n]{{1,{piece}}}\n?|\n"), F.lit(0))
    leaves = F.transform(pieces, lambda p: F.substring(_sha(p), 1, LEAF))
    closed = F.transform(leaves, lambda h: F.when(h.endswith("0"), F.concat(h, F.lit(";"))).otherwise(h))
    sections = F.filter(F.split(F.array_join(closed, " "), "; ?"), lambda s: s != "")
    named = F.transform(sections, lambda s: F.struct(_sha(s).alias("h"), s.alias("s")))
    # One pass over the sections gives both the root's input and the written branches.
    return F.transform(F.array(named), lambda x: F.concat(_sha(F.array_join(F.transform(x, lambda b: b.h), "")), F.array_join(F.transform(x, lambda b: F.concat(F.lit(";"), F.substring(b.h, 1, SECTION), F.lit(" "), b.s)), "")))[0]


def root(print_: Column) -> Column:
    return F.substring(print_, 1, 64)


def leaves(print_: Column) -> Column:
    """The leaf hashes in order."""
    return F.filter(F.split(F.substring(print_, 66, 2**30), "[; ]"), lambda x: F.length(x) == LEAF)


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared distinct leaves over the distinct leaves of both; 1 for equal roots, 0 where nothing is shared."""
    x, y = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    shared = F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), lambda z: 2.0 * F.size(F.array_intersect(z.x, z.y)) / F.greatest(F.size(z.x) + F.size(z.y), F.lit(1)))[0]
    return F.when(root(a) == root(b), 1.0).otherwise(shared)


def edited_leaves(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the leaves of `a` that differ in `b`: those in sections that `b` lacks, if `b` lacks the leaf too."""
    branch = lambda p: F.split(F.substring(p, 66, 2**30), ";")
    numbered = F.transform(leaves(a), lambda h, k: F.struct(k.alias("k"), h.alias("h")))
    lost = F.array_except(leaves(F.concat(F.lit("-" * 65), F.array_join(F.array_except(branch(a), branch(b)), ";"))), leaves(b))
    return F.transform(F.filter(numbered, lambda x: F.array_contains(lost, x.h)), lambda x: x.k)


def following(ids: DataFrame) -> DataFrame:
    """`ids` (doc_id, distinct) with next_id: the next larger id, and for the largest the smallest.

    Ids are dealt by range, so each task orders its own; only the first id of each
    range crosses to its neighbour.
    """
    dealt = materialise(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    firsts = dealt.groupBy("part").agg(F.min("doc_id").alias("first"))
    # One row per task of the range shuffle.
    after = firsts.withColumn("after", F.lead("first").over(Window.orderBy("part"))).select("part", "after")
    start = firsts.agg(F.min("first").alias("start"))
    inside = dealt.withColumn("inside", F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id")))
    return inside.join(F.broadcast(after), "part").join(F.broadcast(start)).withColumn("next_id", F.coalesce("inside", "after", "start")).drop("part", "inside", "after", "start")  # as many rows as tasks, one row


def fingerprint_edits(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """Fingerprints of all `docs` (doc_id, text) and of a half-replaced form of each.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text replaces the last floor(n_chars / 2)
    code points by the first as many (or all) of the next document by doc_id; the
    last is followed by the first, and a lone document by itself. Null texts are
    empty. Repeated rows come back each; where rows share a doc_id their smallest
    text is what precedes them sees. Rows without a doc_id have no next document and are edited with
    an empty one. An empty table gives an empty result; other columns are ignored.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = text.select("doc_id", F.length("text").alias("n")).filter("doc_id is not null").groupBy("doc_id").agg(F.max("n").alias("most"), F.count("*").alias("rows"))
    order = materialise(following(size), "order")
    known = text.filter("doc_id is not null")
    ahead = order.select(F.col("doc_id").alias("for_id"), F.col("next_id").alias("doc_id"), "most")
    heads = known.join(ahead, "doc_id").select("for_id", "doc_id", F.substring("text", F.lit(1), F.floor(F.col("most") / 2).cast("int")).alias("head"), fingerprint(F.col("text"), piece).alias("next_print"))
    if order.filter("rows > 1").limit(1).count():
        heads = heads.groupBy("for_id").agg(F.min(F.struct("head", "next_print")).alias("x")).select("for_id", "x.*")
    both = known.join(heads.drop("doc_id").withColumnRenamed("for_id", "doc_id"), "doc_id")
    lone = text.filter("doc_id is null").select("doc_id", "text", F.lit("").alias("head"), fingerprint(F.lit(""), piece).alias("next_print"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("head", F.lit(1), half))
    rows = both.unionByName(lone).select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_print")
    prints = rows.select("doc_id", "n_chars", _sha(F.col("edited")).alias("edited_sha256"), fingerprint(F.col("text"), piece).alias("fingerprint"), fingerprint(F.col("edited"), piece).alias("edited_fingerprint"), "next_print")
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))
