"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised: 0 makes all equal, 1
leaves them as they are, more sharpens them. The exponent is bisected to meet a target entropy, on
whichever side of 1 it lies, and drawn back towards 1 as far as a source would repeat too often. The weights are
realised as block permutations within a token budget: a source's quota
is filled with whole random permutations of its documents and a last one that is cut
where the quota is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.llm.names import free_names
from stationflow.session import materialise

STEPS, POINTS = 5, 31
#: The sharpest exponent. Entropies below what it gives are not met.
HIGHEST = 64.0
SLICE_ROWS = 5000


def count_tokens(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _bisect(sources: DataFrame, low: float, high: float, met) -> tuple[float, float]:
    """A narrow pair of exponents in [low, high] around the place from which on `met` (an aggregate condition, false below and true above) holds.

    Every pass over the sources tries POINTS exponents at once, which is five halvings.
    """
    for _ in range(STEPS):
        tried = [low + (high - low) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        hits = sources.agg(*[met(F.lit(a)).alias(f"x{k}") for k, a in enumerate(tried)]).first()
        k = next((k for k, x in enumerate(hits) if x), POINTS)
        low, high = (tried[k - 1] if k else low), (tried[k] if k < POINTS else high)
    return low, high


def temperature_weights(sources: DataFrame, entropy_share: float, repetition: float, budget: int | None = None) -> DataFrame:
    """(source, tokens, weight, exponent, entropy, quota) of `sources` (source, tokens > 0).

    The exponent is the one whose mix has the entropy of
    `entropy_share` times the logarithm of the number of sources: below 1 where the natural shares have less entropy, above 1 (up to
    HIGHEST) where they have more. Where a source would repeat more than
    `repetition` times within `budget` tokens (by default all there are), it is the nearest one on the way to 1 that
    keeps the limit, or 1 where none does. `entropy` tells the share of the greatest entropy that the mix
    reached; with one source, or sources of equal size, every exponent gives the same mix.
    """
    total, count = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    budget = int(total) if budget is None else budget
    shares = sources.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    power = lambda a: F.pow("p", a)
    mass = lambda a: F.sum(power(a))
    entropy = lambda a: F.log(mass(a)) - a * F.sum(power(a) * F.log("p")) / mass(a)
    repeats = lambda a: F.max(power(a) / F.col("tokens")) * F.lit(float(budget)) / mass(a)
    target = F.lit(entropy_share) * F.log(F.lit(float(max(count, 1))))
    exponent = 1.0
    if count:
        exponent = _bisect(shares, 0.0, HIGHEST, lambda a: entropy(a) <= target)[1]
        if exponent <= 1:
            exponent = _bisect(shares, exponent, 1.0, lambda a: repeats(a) <= repetition)[1]
        else:
            exponent = _bisect(shares, 1.0, exponent, lambda a: repeats(a) > repetition)[0]
    scale, reached = shares.agg(mass(F.lit(exponent)), entropy(F.lit(exponent)) / F.log(F.lit(float(max(count, 1))))).first()
    scale = scale or 1.0
    weight = power(F.lit(exponent)) / F.lit(float(scale))
    return shares.select("source", "tokens", weight.alias("weight"), F.lit(exponent).alias("exponent"), F.lit(reached).cast("double").alias("entropy"), F.floor(weight * F.lit(float(budget))).cast("long").alias("quota"))


def _order(epoch: Column, seed: int) -> Column:
    """A document's place in a permutation."""
    return F.xxhash64(F.lit(seed), epoch, "doc_id", "digest")


def _running(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """`rows` with `before`: the sum of `value` over the rows of the same keys with a smaller `place`.

    Places are random, so slices of the place range hold about SLICE_ROWS rows each:
    sums run inside slices and over the short list of slices.
    """
    rows = rows.withColumn("_slice", F.floor((F.col("place") / 2.0**63 + 1) / 2 * F.col("slices")))
    sums = rows.groupBy(*keys, "_slice").agg(F.sum(value).alias("_sum"))
    over = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(over(Window.partitionBy(*keys).orderBy("_slice"))), F.lit(0))).drop("_sum")
    inner = F.coalesce(F.sum(value).over(over(Window.partitionBy(*keys, "_slice").orderBy("place", "doc_id", "copy"))), F.lit(0))
    return rows.withColumn("_inner", inner).join(base, [*keys, "_slice"]).withColumn("before", F.col("_base") + F.col("_inner")).drop("_slice", "_base", "_inner")


def plan_mixture(docs: DataFrame, entropy_share: float, repetition: float, budget: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """What a mixture takes: (documents, sources).

    `documents` has (doc_id, source, tokens, digest, copy, whole, cut, place): `whole` full
    permutations take every document, `cut` tells whether the last one does. `docs` has doc_id, text and source;
    a null source is a source of its own, a document without words is taken with every full permutation, and
    repeated rows are documents of their own.
    """
    digest = F.xxhash64("text").alias("digest")
    thin = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("unnamed"), count_tokens(F.col("text")).alias("tokens"), digest)
    rows = thin.groupBy("doc_id", "source", "unnamed", "tokens", "digest").agg(F.count("*").alias("n"))
    rows = materialise(rows, "tokens")
    sources = rows.groupBy("source", "unnamed").agg(F.sum(F.col("tokens") * F.col("n")).alias("tokens"), F.sum("n").alias("rows"))
    sources = materialise(sources, "sources")
    keyed = sources.select(F.struct("source", "unnamed").alias("source"), "tokens").filter("tokens > 0")
    weights = temperature_weights(keyed, entropy_share, repetition, budget)
    weights = weights.select("source.source", "source.unnamed", "weight", "exponent", "entropy", "quota")
    sources = sources.join(weights, ["source", "unnamed"], "left").fillna({"weight": 0.0, "quota": 0})
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(0).cast("int")
    sources = sources.withColumn("whole", whole).withColumn("left", F.col("quota") - F.col("whole") * F.col("tokens"))
    sources = materialise(sources.withColumn("slices", F.ceil(F.col("rows") / SLICE_ROWS)), "sources")
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    placed = each.join(sources.select("source", "unnamed", "whole", "left", "slices"), ["source", "unnamed"])
    placed = placed.withColumn("place", F.xxhash64(F.lit(seed), "whole", "doc_id", "digest", "copy"))
    summed = _running(placed, ["source", "unnamed"], F.col("tokens"))
    documents = summed.withColumn("cut", (F.col("before") + F.col("tokens") <= F.col("left")) & (F.col("tokens") > 0)).drop("before", "left")
    return materialise(documents, "mixture"), sources


def mixture_order(docs: DataFrame, entropy_share: float, repetition: float, budget: int | None = None, seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, epoch, place, weight, exponent, entropy): every taken document with its place in its source's stream.

    `epoch` counts the permutations of a source from 0; `place` numbers the documents within
    an epoch from 0. Within an epoch no document occurs twice. The tokens of a
    source never exceed its quota, and miss it by less than the document at the cut.
    """
    documents, sources = plan_mixture(docs, entropy_share, repetition, budget, seed)
    epochs = F.sequence(F.lit(0), F.col("whole") - F.when(F.col("cut"), 0).otherwise(1))
    taken = documents.filter((F.col("whole") > 0) | F.col("cut")).withColumn("epoch", F.explode(epochs))
    taken = taken.withColumn("place", F.xxhash64(F.lit(seed), "epoch", "doc_id", "digest", "copy"))
    ordered = _running(taken, ["source", "unnamed", "epoch"], F.lit(1))
    told = ordered.join(sources.select("source", "unnamed", "weight", "exponent", "entropy"), ["source", "unnamed"])
    return told.select("doc_id", F.when(~F.col("unnamed"), F.col("source")).alias("source"), "tokens", "epoch", F.col("before").alias("place"), "weight", "exponent", "entropy")


def mix_documents(docs: DataFrame, entropy_share: float, repetition: float, budget: int | None = None, seed: int = 0) -> DataFrame:
    """The rows of `docs` as often as the mixture takes them, with their columns.

    Rows that repeat doc_id, source and text are numbered by their other columns (maps compare as JSON), so a
    repeated run gives each the same count. Columns may have any name and type.
    """
    documents, _ = plan_mixture(docs, entropy_share, repetition, budget, seed)
    helper, copy, again = free_names(docs, "helper", "copy", "again")
    of = lambda name: F.col(f"{helper}.{name}")
    times = (F.col("whole") + F.col("cut").cast("int")).alias("times")
    source = F.when(~F.col("unnamed"), F.col("source")).alias("source")
    key = ["doc_id", "source", "unnamed", "digest"]
    repeated = documents.filter("copy > 1").select(*key).distinct()
    taken = documents.select(*key, "copy", times).filter("times > 0")
    named = lambda df, *more: df.select(F.struct("doc_id", source, "digest", *more).alias(helper))
    same = F.col("doc_id").eqNullSafe(of("doc_id")) & F.col("source").eqNullSafe(of("source")) & (F.xxhash64("text") == of("digest"))
    columns = [f"`{c}`" for c in docs.columns]
    times = F.explode(F.sequence(F.lit(1), of("times").cast("int"))).alias(again)
    if not repeated.limit(1).count():
        return docs.join(named(taken, "times"), same).select(*columns, times).drop(again)
    # Rows that repeat id, source and text are numbered, and each number has its own count.
    match = [F.col(f"t.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    twice = taken.alias("t").join(repeated.alias("r"), match, "left_semi")
    once = named(taken.alias("t").join(repeated.alias("r"), match, "left_anti"), "times")
    whole = docs.join(once, same).select(*columns, times).drop(again)
    flat = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    maps = [f"`{c}`" for c, kind in docs.dtypes if "map<" in kind or kind == "variant"]
    number = F.row_number().over(Window.partitionBy(of("doc_id"), of("source"), of("digest")).orderBy(*flat, *([F.to_json(F.struct(*maps))] if maps else [])))
    marked = docs.join(named(repeated), same).withColumn(copy, number).select(*columns, copy)
    rest = marked.join(named(twice, "copy", "times"), same & (F.col(copy) == of("copy"))).select(*columns, times).drop(again)
    return whole.unionByName(rest)
