"""Language identification by cross-parsing entropy.

From running labelled text of each language a suffix automaton is built. A text is
parsed against each automaton into phrases, each the longest match in the training text from
where the last one ended; phrases run across words. Their number is normalised by the
bits that name a place in the training text, log2 of its length, as in the
cross-parsing estimate of relative entropy, and a byte that the training text does not have
is spelled out. So neither short nor long training text makes a
language cheap. The language that needs the fewest normalised phrases wins.

Texts are parsed in stretches of STRETCH bytes, all stretches and languages of a
batch in step; a stretch begins a phrase of its own, in every language alike.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from stationflow.llm.arrowtext import buffers, strings, with_columns

SAMPLE_ROWS = 64
MODEL_BYTES = 32768
UNDECIDED = "und"
STRETCH = 2048
BLOCK_BYTES = 4 << 20  # text that is parsed at once
#: Bits of a byte that the training text does not have: a flag and the byte.
LITERAL_BITS = 9.0


class Automaton:
    """The suffix automaton of a byte string; its transitions lie in one shared array, each state's at its own offset."""

    def __init__(self, text: bytes) -> None:
        nexts: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for byte in text:
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and byte not in nexts[at]:
                nexts[at][byte] = new
                at = link[at]
            if at >= 0:
                to = nexts[at][byte]
                if length[to] != length[at] + 1:
                    twin = len(nexts)
                    nexts.append(dict(nexts[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    link[to] = link[new] = twin
                    while at >= 0 and nexts[at].get(byte) == to:
                        nexts[at][byte] = twin
                        at = link[at]
                else:
                    link[new] = to
            last = new
        self.bits = float(np.log2(len(text) + 2))
        self.offset, self.owner, self.target = _pack(nexts)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next states, 0 for none."""
        cell = self.offset[state] + byte
        return np.where(self.owner[cell] == state, self.target[cell], 0)

    def parse(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many phrases and how many unseen bytes each stretch has; all step together. Stretches come longest first."""
        phrases, unseen = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        state = np.zeros(len(starts), np.int32)
        alone = self.step(np.zeros(256, np.int32), np.arange(256))
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for k, n in enumerate(active):
            byte, at = data[starts[:n] + k], state[:n]
            to = self.step(at, byte)
            stuck = np.flatnonzero(to == 0)
            begun = alone[byte[stuck]]
            phrases[stuck] += at[stuck] != 0
            unseen[stuck] += begun == 0
            to[stuck] = begun
            state[:n] = to
        return phrases + (state != 0), unseen


def _pack(nexts: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of transitions laid into one array where their cells are free, the fullest first: (offset, owner, target)."""
    total = sum(map(len, nexts))
    owner, target = np.full(8 * total + 512 * 256, -1, np.int32), np.zeros(8 * total + 512 * 256, np.int32)
    taken, offset, start = bytearray(len(owner)), np.zeros(len(nexts), np.int32), 256

    def place(state: int, cell: int) -> None:
        offset[state] = cell - min(nexts[state])
        for byte, to in nexts[state].items():
            at = offset[state] + byte
            taken[at], owner[at], target[at] = 1, state, to

    for state in sorted((s for s, row in enumerate(nexts) if len(row) > 1), key=lambda s: -len(nexts[s])):
        ahead = [byte - min(nexts[state]) for byte in nexts[state]]
        cell, tries = taken.find(0, start), 0
        while any(taken[cell + k] for k in ahead):
            cell, tries = taken.find(0, cell + 1), tries + 1
        place(state, cell)
        if tries > 16:  # crowded: later rows look further on
            start = max(start, cell - 32)
    cell = 255
    for state in (s for s, row in enumerate(nexts) if len(row) == 1):  # rows of one cell fill the holes
        cell = taken.find(0, cell + 1)
        place(state, cell)
    used = len(taken.rstrip(b"\0")) + 256
    return offset, owner[:used].copy(), target[:used].copy()


@lru_cache(maxsize=1)
def _automata(models: tuple[tuple[str, bytes], ...]) -> list[Automaton]:
    return [Automaton(text) for _, text in models]


def _costs(texts: pa.Array, models: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Bits per byte of each text (columns) in each language (rows)."""
    offsets, data = buffers(pc.utf8_lower(texts))
    size = np.diff(offsets)
    n = -(-size // STRETCH)
    owner = np.repeat(np.arange(len(size)), n)
    step = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STRETCH
    starts, sizes = offsets[owner] + step, np.minimum(size[owner] - step, STRETCH)
    out = np.zeros((len(models), len(size)))
    lines = max(1, BLOCK_BYTES // STRETCH)
    order = np.argsort(-sizes, kind="stable")
    for lo in range(0, len(order), lines):
        part = order[lo : lo + lines]
        for k, automaton in enumerate(_automata(models)):
            phrases, unseen = automaton.parse(data, starts[part], sizes[part])
            out[k] += np.bincount(owner[part], weights=phrases * automaton.bits + unseen * LITERAL_BITS, minlength=len(size))
    return out / np.maximum(size, 1)


def _score(costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language (its number) and confidence of each text."""
    best = costs.argmin(axis=0)
    if len(costs) == 1:
        return best, np.ones(costs.shape[1])
    two = np.partition(costs, 1, axis=0)[:2]
    return best, two[1] / np.maximum(two[0] + two[1], 1e-9)


def _training(texts: list[str], model_bytes: int) -> bytes:
    """Running text of up to `model_bytes` bytes: every row's beginning, the room shared evenly, what short rows leave going to the longer ones."""
    rows = sorted(((" " + " ".join(t.lower().split())).encode() for t in texts), key=lambda row: (len(row), row))
    out = bytearray()
    for k, row in enumerate(rows):
        out += row[: (model_bytes - len(out)) // (len(rows) - k)].decode(errors="ignore").encode()
    return bytes(out)


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, model_bytes: int = MODEL_BYTES) -> tuple[tuple[str, bytes], ...]:
    """(language, training text) from `labelled` (doc_id, text, lang).

    The bounded sample: of each language the `rows` rows that come first by a hash of
    doc_id, and of their running text `model_bytes` bytes, shared evenly among the rows.
    At most about 4 * `model_bytes` characters of each language reach the driver. Rows
    without language or text do not count; a language whose rows have only spaces is learned as such.
    """
    known = labelled.filter("lang is not null and text is not null")
    place = F.xxhash64("doc_id").alias("place")
    ids = known.select("lang", place)
    share = ids.groupBy("lang").agg((4.0 * rows / F.count("*")).alias("share"))
    # About 4 * rows candidates per language before any are ordered.
    low = known.select("lang", place, F.substring("text", 1, model_bytes).alias("text")).join(F.broadcast(share), "lang").filter((F.col("place") / 2.0**63 + 1) / 2 <= F.col("share"))  # one row per language
    w = Window.partitionBy("lang")
    first = low.withColumn("rank", F.row_number().over(w.orderBy("place", "text"))).filter(F.col("rank") <= rows)
    part = F.ceil(F.lit(4.0 * model_bytes) / F.max("rank").over(w)).cast("int")
    texts: dict[str, list[str]] = {}
    for lang, text in first.withColumn("part", part).select("lang", F.expr("substring(text, 1, part)")).collect():  # `rows` rows per language, cut
        texts.setdefault(lang, []).append(text)
    return tuple((lang, _training(found, model_bytes)) for lang, found in sorted(texts.items()))


def identify(docs: DataFrame, models: tuple[tuple[str, bytes], ...], text: str = "text", pred: str = "lang_pred", score: str = "score", most_bits: float | None = None) -> DataFrame:
    """`docs` with the predicted language of every whole text and a score from 0 to 1.

    `pred` is a learned language, or `und` where the text is null, has no letter or
    nothing was learned (score 0), and, with `most_bits`, where even the best language needs
    that many bits per byte: at LITERAL_BITS no language says more about the text than its bytes do.
    The score compares the two best languages: 0.5 for a tie,
    towards 1 the clearer the winner; 1 where only one language was learned. Ties go
    to the language first by name. A text in a script that no language has costs every language
    the same, so without `most_bits` it is told as the first by name. Columns of the same names as the new ones
    give way; rows stay one for one.
    """

    def add(batch: pa.RecordBatch) -> list[pa.Array]:
        values = strings(batch.column(batch.schema.get_field_index(text)))
        letters = pc.match_substring_regex(values, r"\p{L}").to_numpy(zero_copy_only=False)
        if not models:
            letters = np.zeros(len(values), bool)
        best, how = np.zeros(len(values), int), np.zeros(len(values))
        if letters.any():
            costs = _costs(values, models)
            best, how = _score(costs)
            if most_bits is not None:
                letters = letters & (costs.min(axis=0) < most_bits)
        names = [lang for lang, _ in models] + [UNDECIDED]
        pick = np.where(letters, best, len(models))
        return [pa.array(names).take(pa.array(pick)), pa.array(np.where(letters, how, 0.0))]

    return with_columns(docs, [StructField(pred, StringType()), StructField(score, DoubleType())], add, text=text)


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 1 modulo 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
