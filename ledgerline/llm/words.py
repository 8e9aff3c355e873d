"""Whole Arrow text columns to words, without a Python loop over the rows.

A byte table is applied to the text buffer of a column in one call, the
result is split on ASCII white space, and every word is replaced by its code
in a vocabulary of the slice.  Slices hold about ``SLICE_BYTES`` of text, so
memory does not depend on how many rows Spark puts into an Arrow batch; one
text longer than that makes a slice of its own and is still taken whole.

A null text is an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

WHITE = re.compile(rb"[\x20\x09-\x0d]")

# A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# A-Z to a-z; ASCII other than letters and digits to a space.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


@dataclass
class Words:
    """Words of consecutive texts: ``codes`` in order, text i holding ``codes[bounds[i]:bounds[i + 1]]``."""

    bounds: np.ndarray
    codes: np.ndarray
    vocab: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def _plain(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def _offsets(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(column.buffers()[1], dtype=np.int32)
    return raw[column.offset : column.offset + len(column) + 1]


def slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of a text column of about ``max_bytes``, at least one row each."""
    column = _plain(column)
    if not len(column):
        return
    ends = _offsets(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield column.slice(start, stop - start)
        start = stop


def each(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of every text of a column without nulls."""
    ends = _offsets(column).tolist()
    data = column.buffers()[2]
    data = b"" if data is None else data.to_pybytes()
    return (data[a:b] for a, b in pairwise(ends))


def text_bytes(column: pa.Array) -> int:
    """UTF-8 bytes of the texts of a slice."""
    ends = _offsets(column)
    return int(ends[-1] - ends[0])


def blocks(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """One text as consecutive parts of about ``max_bytes``, cut before ASCII white space, so that no word is cut."""
    ends = _offsets(column)
    data = memoryview(column.buffers()[2])
    start, stop = int(ends[0]), int(ends[1])
    while start < stop:
        space = WHITE.search(data, min(start + max_bytes, stop), stop)
        cut = space.start() if space else stop
        yield pa.StringArray.from_buffers(
            1, pa.py_buffer(np.array([0, cut - start], dtype=np.int32).tobytes()), pa.py_buffer(data[start:cut])
        )
        start = cut


def translated(column: pa.Array, table: bytes) -> pa.Array:
    """Every byte of the texts through ``table``, which must map ASCII to ASCII and keep other bytes."""
    if not len(column):
        return pa.array([], pa.string())
    ends = _offsets(column)
    data = column.buffers()[2]
    data = b"" if data is None else data[int(ends[0]) : int(ends[-1])].to_pybytes()
    moved = (ends - ends[0]).astype(np.int32)
    return pa.StringArray.from_buffers(len(column), pa.py_buffer(moved.tobytes()), pa.py_buffer(data.translate(table)))


def flat_words(column: pa.Array, table: bytes) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text and the words of all texts in order."""
    parts = pc.ascii_split_whitespace(translated(column, table))
    flat = parts.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0
    before = np.concatenate(([0], np.cumsum(full)))
    bounds = before[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
    return bounds.astype(np.int64), flat.filter(pa.array(full)) if len(flat) else flat


def words(column: pa.Array, table: bytes) -> Words:
    bounds, flat = flat_words(column, table)
    coded = flat.dictionary_encode()
    return Words(bounds, np.asarray(coded.indices, dtype=np.int64), coded.dictionary)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each ``bounds[i]:bounds[i + 1]``; 0 where that is empty."""
    total = np.concatenate((np.zeros(1, dtype=np.result_type(values.dtype, np.int64)), np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]
