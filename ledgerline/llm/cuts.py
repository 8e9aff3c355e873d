"""Whole texts cut into words that a tokenizer never joins, and the frequent rows of a count.

A text is taken with a space before it, as both kinds of tokenizers here see
it.  ``cut`` gets the bytes of many texts and says where a new word begins;
a tokenizer's result on a text is then the results on its words, one after
the other.  Slices hold about ``max_bytes`` of text; one longer text is given
in parts, so that memory follows the slice and the longest word, not the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W

Cut = Callable[[np.ndarray], np.ndarray]


def prefixed(column) -> pa.Array:
    """The texts as binary, each after a space; a null is an empty text."""
    return pc.binary_join_element_wise(pa.scalar(""), W._plain(column), pa.scalar(" ")).cast(pa.binary())


def coded(texts: pa.Array, cut: Cut) -> W.Words:
    """The words of binary texts, as codes in a vocabulary of the slice."""
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    starts = cut(data)
    starts[ends[:-1][np.diff(ends) > 0]] = True
    at = np.flatnonzero(starts).astype(np.int32)
    offsets = np.append(at, np.int32(len(data)))
    flat = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    own = flat.dictionary_encode()
    return W.Words(np.searchsorted(at, ends), np.asarray(own.indices, dtype=np.int64), own.dictionary)


def parts(text: pa.Array, cut: Cut, max_bytes: int) -> Iterator[pa.Array]:
    """One text in consecutive parts of about ``max_bytes``, each beginning a word."""
    data = np.frombuffer(text[0].as_buffer(), dtype=np.uint8)
    at = 0
    while at < len(data):
        end, size = at, max_bytes
        while end == at:
            # A word is only known to end where the next begins; three bytes more show the next character.
            starts = np.flatnonzero(cut(data[at : at + size + 3])[:size])
            starts = starts[starts > 0]
            end = len(data) if at + size >= len(data) else at + int(starts[-1]) if len(starts) else at
            size *= 2
        yield pa.array([data[at:end].tobytes()], pa.binary())
        at = end


def blocks(column, cut: Cut, max_bytes: int) -> Iterator[tuple[int, int, bool, pa.Array]]:
    """``(first row, rows, whole, prefixed texts)``; a long text comes in several blocks, ``whole`` with its last."""
    at = 0
    for own in W.slices(column, max_bytes):
        texts = prefixed(own)
        if len(own) == 1 and texts.nbytes > 2 * max_bytes:
            found = list(parts(texts, cut, max_bytes))
            for k, part in enumerate(found):
                yield at, 1, k == len(found) - 1, part
        else:
            yield at, len(own), True, texts
        at += len(own)


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + sizes[i] - 1``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def frequent(counted: DataFrame, count: str, limit: int) -> Column:
    """Rows whose count reaches the lowest power of two that at most ``limit`` rows reach."""
    level = F.floor(F.log2(count)).cast("int")
    sizes = {r["level"]: r["n"] for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, rows = 63, 0
    while least > 0 and rows + sizes.get(least - 1, 0) <= limit:
        least -= 1
        rows += sizes.get(least, 0)
    return F.col(count) >= F.lit(1 << least if least < 63 else (1 << 63) - 1).cast("long")
