"""Chat formatting of preference pairs: one prompt from the common turns, two masked completions.

A conversation is one training record, so its turns are gathered into one row, once for
each side; prefix, prompt, completions and masks then come from arrays within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
TRAINED = "assistant"


def _gathered(turns: DataFrame, name: str) -> DataFrame:
    """Per pair the turns (role, text) in the order of turn, role and text; null turns first, null roles `unknown`, null texts empty."""
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.filter("pair_id is not null").groupBy("pair_id").agg(F.array_sort(F.collect_list(turn)).alias("x"))
    return rows.select("pair_id", F.transform("x", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias(name))


def render(role: Column, text: Column) -> Column:
    """One turn as text: a role line, the content and an end marker."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit(CLOSE))


def _told(turns: Column) -> Column:
    """Turns rendered one after the other."""
    return F.array_join(F.transform(turns, lambda t: render(t.role, t.text)), "")


def _spans(turns: Column) -> Column:
    """What the loss sees of rendered turns, as (start, end) in code points: assistant content with its end marker."""
    size = F.transform(turns, lambda t: F.length(render(t.role, t.text)))
    start = F.aggregate(size, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    placed = F.zip_with(turns, start, lambda t, at: F.struct(t.role.alias("role"), (at + F.length(t.role) + len(OPEN.format(""))).alias("start"), (at + F.length(render(t.role, t.text))).alias("end")))
    return F.transform(F.filter(placed, lambda s: s.role == TRAINED), lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Pairs of conversations (pair_id, turn, role, text) as training rows.

    Returns pair_id, n_prompt_turns, prompt, chosen, chosen_spans, rejected,
    rejected_spans. The prompt holds the longest common prefix of turns (role and
    text equal) once; the completions hold what follows, and their spans
    (start, end in code points) are what the loss sees: assistant content with its end
    marker. Where one conversation is a prefix of the other its completion is empty;
    equal conversations give two empty completions. A pair_id on one side only, or null, is
    left out. Null turns come first, null roles are `unknown`, null texts empty;
    turns with equal numbers are ordered by role and text; other columns are ignored.
    """
    both = _gathered(chosen, "a").join(_gathered(rejected, "b"), "pair_id")
    differs = F.zip_with("a", "b", lambda x, y: ~x.eqNullSafe(y))
    length = F.when(F.array_contains(differs, True), F.array_position(differs, True) - 1).otherwise(F.size("a")).cast("int")
    cut = both.withColumn("n_prompt_turns", length)
    n = F.col("n_prompt_turns")
    tail = lambda side: F.slice(side, n + 1, F.greatest(F.size(side) - n, F.lit(0)))
    parts = cut.select("pair_id", "n_prompt_turns", F.slice("a", F.lit(1), n).alias("p"), tail("a").alias("c"), tail("b").alias("r"))
    c, r = F.col("c"), F.col("r")
    return parts.select("pair_id", "n_prompt_turns", _told(F.col("p")).alias("prompt"), _told(c).alias("chosen"), _spans(c).alias("chosen_spans"), _told(r).alias("rejected"), _spans(r).alias("rejected_spans"))
