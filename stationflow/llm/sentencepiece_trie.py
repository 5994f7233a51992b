"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Texts are cut into marked words (leading spaces and what follows up to the next
space), which no piece crosses. The distinct words of a batch are sorted, so that they are a
trie in depth-first order, and a forward pass walks it: the state after a prefix is
kept on a stack and used by every word with that prefix.

The public model file is a BPE model. Summing piece scores, as for a unigram model, would
not give the ids that it stands for. So a state holds, instead of the best sum, the one piece
with which the BPE encoding of the prefix ends: a piece can follow another exactly
when encoding the two together gives these two, which is checked by undoing their
merges. The ids equal those of the SentencePiece library. Characters without a piece
become byte pieces.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField

from stationflow.llm.arrowtext import distinct_units, strings, with_columns

MARK = "▁"
MEMO = 1 << 18
SLICE = 1 << 18  # words whose ids are put together at once
CUT_BYTES = 4 << 20  # text that is encoded at once
_BREAKS = np.isin(np.arange(256), [10])


@dataclass(frozen=True)
class Model:
    """The tables of a model file: bounded by its vocabulary."""

    pieces: tuple[bytes, ...]  # what each id decodes to
    ids: dict[str, int]  # pieces that text can give
    rank: dict[str, tuple[float, int]]  # merge order: smaller merges first
    parts: dict[int, tuple[int, int]]  # the two pieces a piece is merged from
    order: dict[int, int]  # place of a piece in the merge order
    whole: frozenset[int]  # pieces that encode to themselves
    bytes_: tuple[int, ...]  # ids of the 256 byte pieces


def merge(text: str, rank: dict[str, tuple[float, int]]) -> list[str]:
    """BPE by repeated best merges, leftmost first among equals; a heap of neighbours finds the next one, so a run of n characters takes about n log n steps."""
    parts: list[str] = list(text)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(k: int) -> None:
        if k >= 0 and after[k] < n and (pair := parts[k] + parts[after[k]]) in rank:
            heapq.heappush(heap, (rank[pair][0], k, pair))

    for k in range(n):
        offer(k)
    while heap:
        _, k, pair = heapq.heappop(heap)
        right = after[k] if parts[k] else n
        if right == n or parts[k] + parts[right] != pair:
            continue  # one of the two is merged already
        parts[k], parts[right] = pair, ""
        after[k] = after[right]
        if after[k] < n:
            before[after[k]] = k
        offer(before[k])
        offer(k)
    return [p for p in parts if p]


@lru_cache(maxsize=1)
def load(path: str) -> Model:
    """The tables of a SentencePiece BPE model file without text normalisation and with a dummy leading space."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, rank, bytes_, decoded = {}, {}, [0] * 256, []
    for k in range(sp.get_piece_size()):
        piece = sp.id_to_piece(k)
        if sp.is_byte(k):
            bytes_[int(piece[3:5], 16)] = k
            decoded.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(k) or sp.is_unknown(k):
            decoded.append(b"")
        else:
            ids[piece] = k
            rank[piece] = (-sp.get_score(k), k)
            decoded.append(piece.replace(MARK, " ").encode())
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in ids):
        raise ValueError("pieces that cross words are not supported")
    order = {ids[p]: k for k, p in enumerate(sorted(ids, key=rank.__getitem__))}
    parts, whole = {}, set()
    for piece, k in ids.items():
        if len(piece) == 1:
            whole.add(k)
            continue
        # The last merge of the piece: encode it without its own rank.
        pair = merge(piece, {p: r for i in range(len(piece)) for j in range(i + 2, len(piece) + 1) if (p := piece[i:j]) != piece and (r := rank.get(p))})
        if len(pair) == 2 and all(p in ids for p in pair):
            parts[k] = (ids[pair[0]], ids[pair[1]])
            whole.add(k)
    return Model(tuple(decoded), ids, rank, parts, order, frozenset(whole), tuple(bytes_))


class Forward:
    """The forward pass over sorted words: a stack of states, one per character of the current prefix."""

    def __init__(self, model: Model) -> None:
        self.model, self.memo = model, {}
        self.merged = {pair: k for k, pair in model.parts.items()}
        self.whole = {p: k for p, k in model.ids.items() if k in model.whole}
        self.reach: dict[str, int] = {}  # length of the longest piece with these last three characters
        for p in self.whole:
            if len(p) > 2:
                self.reach[p[-3:]] = max(len(p), self.reach.get(p[-3:], 0))

    def follows(self, a: int, b: int) -> bool:
        """Whether encoding the texts of `a` and `b` together gives just these: no merge across the border comes before those that made them."""
        key = a << 32 | b
        if (known := self.memo.get(key)) is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[key] = self._follows(a, b)
        return known

    def _follows(self, a: int, b: int) -> bool:
        order, parts = self.model.order, self.model.parts
        first, limit = order.get, len(order) + 1
        while True:
            across = self.merged.get((a, b))
            # At equal places the left merge comes first, hence the half steps.
            if across is not None and first(across) < limit:
                return False
            made_a, made_b = (first(x) if x in parts else -1 for x in (a, b))
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, parts[a][1]
            else:
                limit, b = made_b + 0.5, parts[b][0]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sorted distinct words one after the other, and how many each has."""
        ids, whole, reach, follows, memo = self.model.ids, self.whole, self.reach, self.follows, self.memo
        last, back = [0], [0]  # per prefix: the piece it ends with (-1: a character without piece), where that begins
        before, out, counts = "", [], []
        for word in words:
            if MARK * 2 in word:
                found = [x for p in merge(word, self.model.rank) for x in ([ids[p]] if p in ids else [self.model.bytes_[c] for c in p.encode()])]
                out += found
                counts.append(len(found))
                continue
            n, k = len(word), 0
            top = min(n, len(before))
            while k < top and word[k] == before[k]:
                k += 1
            del last[k + 1 :], back[k + 1 :]
            for end in range(k + 1, n + 1):
                piece = -1
                if word[end - 1] in ids:
                    for start in range(max(0, end - reach.get(word[end - 3 : end], 2) if end > 2 else 0), end):
                        x = whole.get(word[start:end])
                        if x is None:
                            continue
                        left = last[start]
                        if start == 0 or left < 0 or memo.get(left << 32 | x) or follows(left, x):
                            piece = x
                            break
                    else:
                        raise AssertionError(f"no piece ends {word[:end]!r}")
                    last.append(piece)
                    back.append(start)
                else:
                    last.append(-1)
                    back.append(end - 1)
            before, at, found = word, n, []
            while at:
                if last[at] < 0:
                    found += [self.model.bytes_[c] for c in reversed(word[at - 1].encode())]
                else:
                    found.append(last[at])
                at = back[at]
            out += reversed(found)
            counts.append(len(found))
        return np.array(out, np.int32), np.array(counts, np.int64)


@lru_cache(maxsize=1)
def _forward(path: str) -> Forward:
    return Forward(load(path))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def encode_texts(texts: pa.Array, path: str) -> pa.Array:
    """Lists of ids."""
    marked = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar(" ", texts.type), pc.replace_substring(texts, MARK, " "), pa.scalar("", texts.type)))
    units, index, counts = distinct_units(marked, _BREAKS)
    words = units.cast(pa.string()).to_pylist()
    words = [w.replace(" ", MARK) for w in words]
    order = sorted(range(len(words)), key=words.__getitem__)
    flat, sizes = _forward(path).encode([words[k] for k in order])
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    del words, units
    starts = np.cumsum(sizes) - sizes
    index = place[index]
    per_word = np.concatenate([[0], np.cumsum(sizes[index])])
    ids = np.empty(int(per_word[-1]), np.int32)
    for lo in range(0, len(index), SLICE):
        where = index[lo : lo + SLICE]
        n = sizes[where]
        total = np.cumsum(n)
        ids[per_word[lo] : per_word[lo] + total[-1]] = flat[np.repeat(starts[where] - (total - n), n) + np.arange(total[-1])]
    bounds = per_word[np.concatenate([[0], np.cumsum(counts)])]
    return _lists(ids, np.diff(bounds))


def decode_ids(ids: pa.Array, path: str) -> pa.Array:
    """Texts of lists of ids, without the dummy leading space; bytes that are no UTF-8 become U+FFFD, null lists empty texts."""
    pieces = pa.array(load(path).pieces, pa.binary())
    flat = ids.flatten()
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    known = pieces.take(flat)
    ends = np.frombuffer(known.buffers()[1], np.int32)[: len(known) + 1].astype(np.int64) if len(known) else np.zeros(1, np.int64)
    joined = ends[np.concatenate([[0], np.cumsum(counts)])]
    data = known.buffers()[2] if len(known) and known.buffers()[2] is not None else pa.py_buffer(b"")
    # One space at the front of each text is the dummy prefix.
    raw = np.frombuffer(data, np.uint8)
    begin = joined[:-1]
    drop = np.zeros(len(raw), bool)
    some = begin[begin < joined[1:]]
    drop[some[raw[some] == 32]] = True
    gone = np.concatenate([[0], np.cumsum(drop)])
    out = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((joined - gone[joined]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw[~drop]))])
    try:
        return out.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()], pa.string())


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", count: str = "n_pieces", check: str | None = None) -> DataFrame:
    """`docs` with the piece ids of every whole text and their number.

    `model` is a model file that every executor can open, installed like the library. Null and
    empty texts have no piece. With `check`, that column tells whether decoding the ids gives the text back (a
    literal mark character comes back as a space and is not the same). Columns of the same names as the
    new ones give way; rows stay one for one.
    """

    def add(batch: pa.RecordBatch) -> list[pa.Array]:
        values = strings(batch.column(batch.schema.get_field_index(text)))
        lists = encode_texts(values, model)
        out = [lists, pc.list_value_length(lists)]
        return [*out, pc.equal(decode_ids(lists, model), values)] if check else out

    fields = [StructField(ids, ArrayType(IntegerType(), False)), StructField(count, IntegerType())]
    return with_columns(docs, fields + ([StructField(check, BooleanType())] if check else []), add, text, CUT_BYTES)


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`rows` with the text of a column of piece ids; null ids give an empty text."""
    return with_columns(rows, [StructField(text, StringType())], lambda batch: [decode_ids(batch.column(batch.schema.get_field_index(ids)), model)])
