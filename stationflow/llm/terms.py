"""Terms of text columns: distinct terms of a batch and where they stand, with numpy and Arrow inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stationflow.llm.arrowtext import NOT_ALNUM, buffers


def batch_terms(texts: pa.Array, apart: np.ndarray = NOT_ALNUM) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms as binary, each occurrence's number among them, occurrences of each text), text after text.

    Terms are the longest runs of bytes outside `apart`, A-Z lower-cased; by default letters and digits
    of ASCII and all other characters beyond it.
    """
    offsets, data = buffers(texts)
    text, at = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    text = text + (((text >= 65) & (text <= 90)).astype(np.uint8) << 5)
    inside = ~apart[text]
    if not inside.any():
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < at[1:]]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(kept[starts], kept[-1]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(text[inside]))]).dictionary_encode()
    return terms.dictionary, terms.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(starts, at))
