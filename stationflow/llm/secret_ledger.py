"""Secret scans with an incremental ledger of blobs.

Every historical version of every path is addressed by its content (SHA-256). The
ledger is a table of what was scanned: one row for each blob and run, with the rules
the blob was scanned with and the spans they found. A run scans only pairs of blob and
rule version that the ledger does not have, each blob once however many paths and
versions hold it, and findings are joined back to all of them.

A rule that changes gets a new version, so that old blobs are scanned with it and with it alone.
A run writes one folder of the ledger under its name and does not read that folder,
so a run that died halfway is repeated under the same name and replaces what it left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.llm.arrowtext import bounded_batches, give_back, strings
from stationflow.session import materialise

LEDGER = "blob binary, rules array<string>, spans array<struct<rule: string, start: long, end: long>>, run string"
FOUND = "blob binary, rules array<string>, spans array<struct<rule: string, start: long, end: long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and not overlapping; those whose `group` has fewer than `least` characters are dropped."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# --- Fixed values: forms of secrets. The order is that of spans that start together ---------------
# Of the runs `AKIA[A-Z0-9]+` and `[0-9a-f]+` those of 18 and 16 characters or more count, which the patterns say themselves.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 12, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", 1, r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def digest(text: Column) -> Column:
    """A text's address: the SHA-256 of its UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none where there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER)
        raise


def unseen_pairs(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """`blobs` (blob, ...) with `missing`: a bit for each rule the blob was not scanned with. Blobs that miss none are left out."""
    # As many entries a blob as there were rule versions.
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("_seen"))
    bit = lambda i, rule: F.when(F.array_contains("_seen", rule.name), 0).otherwise(1 << i).cast("long")
    missing = reduce(lambda a, b: a + b, [bit(i, r) for i, r in enumerate(rules)])
    return blobs.join(seen, "blob", "left").withColumn("missing", missing).filter("missing > 0").drop("_seen")


def _find(text: bytes, pattern: re.Pattern, rule: Rule) -> list[tuple[int, int]]:
    # Bytes stand for characters in every pattern: classes are ASCII, and letters in either case are too.
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    known = [(r, re.compile(r.pattern.encode())) for r in rules]
    kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out, scanned = [], []
        for text, missing in zip(strings(batch.column(2)).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
            raw, asked = text.as_py(), [k for i, k in enumerate(known) if missing >> i & 1]
            spans = [(rule.name, *span) for rule, pattern in asked for span in _find(raw, pattern, rule)]
            if spans and not raw.isascii():
                before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                spans = [(name, int(before[a]), int(before[b])) for name, a, b in spans]
            scanned.append([rule.name for rule, _ in asked])
            out.append([{"rule": name, "start": a, "end": b} for name, a, b in spans])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scanned, pa.list_(pa.string())), pa.array(out, kind)], names=["blob", "rules", "spans"])
        give_back()


def scan_new(versions: DataFrame, addressed: DataFrame, ledger: str, run: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger does not have and write it there as run `run`; returns the ledger.

    `versions` has (row, blob, text), `addressed` the same rows as (row, blob), written already. `row` is a hash of
    what tells rows apart; of the rows of an unseen blob those with the smallest one are scanned.
    """
    spark = versions.sparkSession
    bounded_batches(spark)
    before = read_ledger(spark, ledger).filter(F.col("run") != run)
    first = addressed.groupBy("blob").agg(F.min("row").alias("row"))
    todo = materialise(unseen_pairs(first, before, rules), "unseen")
    # Joined by row and blob, so copies of one text are not one key.
    texts = versions.join(todo, ["row", "blob"]).select("blob", "missing", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.mapInArrow(partial(_scan, rules=rules), FOUND).withColumn("run", F.lit(run))
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(ledger)
    return read_ledger(spark, ledger)


def scan_history(versions: DataFrame, ledger: str, run: str, rules: tuple[Rule, ...] = RULES, keys: tuple[str, ...] = ("path", "version")) -> DataFrame:
    """`keys` of every row of `versions`, its `blob`, and `spans`: what the rules find in its text, by start, then in the order of the rules.

    `versions` has the columns `keys` and `text` (no key is named row, blob, text or spans); others are ignored. Rows that repeat come back as often. A null text is an empty one; a
    null key is a key of its own. A span is (kind, start, end) of the whole match in code points, end exclusive. An empty table gives an
    empty result and leaves an empty run. `ledger` is a folder that grows with every run; `run` names this one.
    """
    columns = [f"`{k}`" for k in keys]
    named = versions.select(*columns, F.xxhash64(*columns).alias("row"), digest(F.col("text")).alias("blob"), "text")
    addressed = materialise(named.drop("text"), "addresses")
    known = scan_new(named.select("row", "blob", "text"), addressed.select("row", "blob"), ledger, run, rules)
    order = F.array(*[F.lit(r.name) for r in rules])
    span = F.explode("spans").alias("span")
    hits = known.filter(F.size("spans") > 0).select("blob", span).filter(F.array_contains(order, F.col("span.rule"))).distinct()
    place = F.array_position(order, F.col("span.rule"))
    sorted_spans = F.array_sort(F.collect_list(F.struct(F.col("span.start").alias("start"), place.alias("place"), F.col("span.end").alias("end"))))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    told = F.transform(sorted_spans, lambda s: F.struct(F.element_at(kinds, s["place"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    per_blob = materialise(hits.groupBy("blob").agg(told.alias("spans")), "findings")
    none = F.array().cast("array<struct<kind: string, start: long, end: long>>")
    return addressed.join(per_blob, "blob", "left").select(*columns, "blob", F.coalesce("spans", none).alias("spans"))


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
