"""Words of whole Arrow columns of texts, cut without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Letters, digits and everything beyond ASCII, A-Z lower-cased; the rest of ASCII separates.
_TERMS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in _LOWER)


def plain(texts: pa.Array) -> pa.Array:
    """Texts as strings of their own buffers, nulls as empty texts."""
    return pc.cast(pc.fill_null(texts, ""), pa.large_string())


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case, other letters as they are."""
    return _translated(plain(texts), _LOWER)


def term_text(texts: pa.Array) -> pa.Array:
    """Texts lower-cased (A-Z), with a blank for each ASCII character but letters and digits."""
    return _translated(plain(texts), _TERMS)


def _translated(texts: pa.Array, table: bytes) -> pa.Array:
    # ASCII goes to ASCII, so places and encoding stay as they are.
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    body = memoryview(data)[offsets[0] : offsets[-1]] if data is not None else b""
    moved = pa.py_buffer(bytes(body).translate(table))
    starts = pa.py_buffer((offsets - offsets[0]).tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, starts, moved])


def cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words (runs of other characters than ASCII white space) of all texts in a row, and how
    many each text has."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    # White space at an end leaves an empty part there.
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not there.all():
        gone = np.bincount(np.repeat(np.arange(len(counts)), counts)[~there], minlength=len(counts))
        counts = counts - gone
        flat = flat.filter(pa.array(there))
    return flat.dictionary_encode(), counts
