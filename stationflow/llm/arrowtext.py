"""Text columns as byte buffers: words, shingles and distinct units with numpy and Arrow inside tasks."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

import stationflow

BATCH_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
_K = 0x9E3779B97F4A7C15
_U = np.uint64


def bounded_batches(spark: SparkSession) -> None:
    """Make Python tasks ready: bounded batches, and this package on every executor.

    The bytes of a batch are bounded, so that long texts need no more memory than short
    ones. The package goes out once per application, also where it is installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_stationflow_shipped", False):
        return
    home = Path(stationflow.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="stationflow-"), "stationflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    context.addPyFile(str(archive))  # served by the driver
    context._stationflow_shipped = True


def give_back() -> None:
    """Return freed memory to the system, which a reused Python worker would hold otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def with_columns(df: DataFrame, fields: list[StructField], add: Callable[[pa.RecordBatch], list[pa.Array]], text: str | None = None, limit: int = BATCH_BYTES) -> DataFrame:
    """`df` with the columns that `add` makes of each batch; columns of the same names give way.

    With `text`, batches are cut so that this column has about `limit` bytes in each; a longer text goes alone.
    """
    bounded_batches(df.sparkSession)
    names = {f.name.lower() for f in fields}
    kept = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in names])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            cuts = [(0, whole.num_rows)] if text is None else chunks(buffers(whole.column(whole.schema.get_field_index(text)))[0], limit)
            for lo, hi in cuts:
                batch = whole.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*batch.columns, *add(batch)], names=[*batch.schema.names, *[f.name for f in fields]])
                give_back()

    # Arrow stages do not take names with dots.
    plain = [f"column {k}" if "." in c else c for k, c in enumerate(kept.columns)]
    inner = kept.toDF(*plain)
    grown = inner.mapInArrow(grow, StructType([*inner.schema.fields, *fields]))
    return grown if plain == kept.columns else grown.toDF(*kept.columns, *[f.name for f in fields])


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column without nulls (null is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than texts) and the bytes they point into."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    if len(texts) == 0 or at is None:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `limit` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as long as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 1)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n, k, _U)])) for k in (_K, pow(_K, -1, 1 << 64)))
        return self.up, self.down


_POWERS = _Powers()


WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def word_hashes(offsets: np.ndarray, data: np.ndarray, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words between bytes of `apart`, A-Z lower-cased, text after text, and how many each text has.

    By default words are `[^\\x20\\x09-\\x0D]+`.
    """
    text = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    text = text + (((text >= 65) & (text <= 90)).astype(np.uint8) << 5)
    inside = ~apart[text]
    new = np.zeros(len(text) + 1, bool)
    new[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | new[1:-1]
    last[:-1] &= ~inside[1:] | new[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _POWERS.upto(len(text) + 1)
    sums = np.zeros(len(text) + 1, _U)
    np.cumsum((text.astype(_U) + _U(1)) * up[: len(text)], out=sums[1:])
    counts = np.diff(np.searchsorted(starts, at))
    return mix((sums[ends] - sums[starts]) * down[starts]), counts


def shingle_sets(offsets: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles of `width` words as sorted 64-bit hashes, and how many each text has.

    A text of fewer words has its whole sequence as one shingle, a text without
    words none.
    """
    words, counts = word_hashes(offsets, data)
    ends = np.cumsum(counts)
    begins = ends - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(n)])
    # Shingle k of a text begins at its word k.
    head = np.arange(starts[-1]) + np.repeat(begins - starts[:-1], n)
    left = np.repeat(ends, n) - head
    tokens = np.minimum(left, width).astype(_U)
    padded = np.concatenate([words, np.zeros(width, _U)])
    for k in range(width):
        part = padded[head + k] * _U((_K * (2 * k + 3)) % (1 << 64) | 1)
        tokens = tokens + np.where(left > k, part, _U(0))
        tokens = mix(tokens)
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        tokens[lo:hi].sort()
    keep = np.ones(len(tokens), bool)
    keep[1:] = tokens[1:] != tokens[:-1]
    keep[starts[:-1][n > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return tokens[keep], total[starts[1:]] - total[starts[:-1]]


def distinct_units(texts: pa.Array, breaks: np.ndarray, longest: int | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts cut into units: the distinct units (binary), each unit's number, and how many units each text has.

    A unit begins at a space that follows no space, and at and after every byte
    for which `breaks` is set; together a text's units are the whole text. With
    `longest`, longer units are cut.
    """
    offsets, data = buffers(texts)
    text, at = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if not len(text):
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    space, cut = text == 32, breaks[text]
    first = space | cut
    first[1:] = (space[1:] & ~space[:-1]) | cut[1:] | cut[:-1]
    first[at[:-1][at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(first)
    if longest:
        size = np.diff(np.append(starts, len(text)))
        if size.max() > longest:
            n = -(-size // longest)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            starts = np.repeat(starts, n) + step * longest
    ends = np.append(starts, len(text)).astype(np.int32)
    units = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(text))]).dictionary_encode()
    return units.dictionary, units.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(starts, at))
