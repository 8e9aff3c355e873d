"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are words (letters, digits and non-ASCII characters after lower-casing
A-Z).  A pattern is a window of ``window`` consecutive words of a benchmark
item; an item with fewer words is one pattern.  Patterns are grouped by their
number of words ``m``, and every group is searched by Wu and Manber's method:

* blocks are ``min(block, m)`` consecutive words;
* the shift table maps the hash of a block to its distance from the end of a
  pattern (the smallest over all patterns); blocks in no pattern allow a shift
  of ``m - block + 1`` positions;
* positions are probed that far apart; where a probed block allows the full
  shift, no pattern can end before the next probe and all positions up to it
  are skipped;
* at the other positions the shift table is asked again, a shift of 0 selects
  the patterns with that suffix block, and a direct comparison of all words
  confirms the occurrence.

Patterns travel to the workers in chunks of at most ``chunk_words`` pattern
words (about 25 MB), one search for each chunk, so what is broadcast has a
fixed bound whatever the size of the benchmark.

Nulls and edge cases: a null or empty text has no words; items without words
are no patterns; several rows with one ``item_id`` count as one item; items
with a null ``item_id`` mark words as hit but are in no list of items.
Overlapping windows mark each word once.  Repeated documents are searched each
on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W

BLOCK_WORDS = 2
CHUNK_WORDS = 3_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _block_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        out = (out ^ column.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Group:
    """Patterns of ``m`` words: shift table over block hashes, patterns sorted by the hash of their last block."""

    m: int
    block: int
    keys: np.ndarray
    shifts: np.ndarray
    suffixes: np.ndarray
    patterns: np.ndarray
    items: np.ndarray

    @property
    def most(self) -> int:
        return self.m - self.block + 1


@dataclass
class Patterns:
    vocab: pa.Array
    item_ids: list
    groups: list[Group]


def _group(patterns: np.ndarray, items: np.ndarray, block_words: int) -> Group:
    m = patterns.shape[1]
    block = min(block_words, m)
    hashes, shifts = [], []
    for end in range(block, m + 1):
        hashes.append(_block_hash([patterns[:, end - block + k] for k in range(block)]))
        shifts.append(np.full(len(patterns), m - end))
    hashes, shifts = np.concatenate(hashes), np.concatenate(shifts)
    order = np.lexsort((shifts, hashes))
    hashes, shifts = hashes[order], shifts[order]
    first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    suffix = _block_hash([patterns[:, m - block + k] for k in range(block)])
    order = np.argsort(suffix, kind="stable")
    return Group(m, block, hashes[first], shifts[first], suffix[order], patterns[order], items[order])


def compile_patterns(rows: list[tuple], window: int, block_words: int = BLOCK_WORDS) -> Patterns:
    """Tables for benchmark rows ``(item_id, text)``."""
    if not rows:
        return Patterns(pa.array([], pa.string()), [], [])
    found = W.words(pa.array([r[1] for r in rows], pa.string()).fill_null(""), W.ALNUM)
    by_size: dict[int, tuple[list, list]] = {}
    for i in range(len(rows)):
        own = found.codes[found.bounds[i] : found.bounds[i + 1]]
        m = min(window, len(own))
        if m:
            views = np.lib.stride_tricks.sliding_window_view(own, m)
            patterns, items = by_size.setdefault(m, ([], []))
            patterns.append(views)
            items.append(np.full(len(views), i))
    groups = [_group(np.concatenate(p), np.concatenate(i), block_words) for _, (p, i) in sorted(by_size.items())]
    return Patterns(found.vocab, [None if r[0] is None else str(r[0]) for r in rows], groups)


def _lookup(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    return at, keys[at] == asked


def _occurrences(group: Group, codes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(first word position, row in group.items)`` of every occurrence."""
    n = np.diff(bounds)
    able = np.flatnonzero(n >= group.m)
    if not len(able):
        return
    # Probes: ends m, m + most, m + 2 * most, ... of each text (an end is the position after the last word).
    count = (n[able] - group.m) // group.most + 1
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    ends = np.repeat(bounds[able] + group.m, count) + nth * group.most
    limit = np.repeat(bounds[able + 1], count)
    hashes = _block_hash([codes[ends - group.block + k] for k in range(group.block)])
    at, known = _lookup(group.keys, hashes)
    # A pattern may end from here + shift on; the full shift reaches the next probe.
    shift = group.shifts[at][known]
    ends, limit = ends[known], limit[known]
    steps = group.most - shift
    nth = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    tests = np.repeat(ends + shift, steps) + nth
    tests = tests[tests <= np.repeat(limit, steps)]
    if not len(tests):
        return
    hashes = _block_hash([codes[tests - group.block + k] for k in range(group.block)])
    at, known = _lookup(group.keys, hashes)
    zero = known & (group.shifts[at] == 0)
    tests, hashes = tests[zero], hashes[zero]
    # Patterns whose suffix block has that hash, compared word by word.
    low, high = np.searchsorted(group.suffixes, hashes), np.searchsorted(group.suffixes, hashes, side="right")
    size = high - low
    for part in np.array_split(np.arange(len(tests)), max(1, int(size.sum()) // 200_000 + 1)):
        reps = size[part]
        nth = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        rows = np.repeat(low[part], reps) + nth
        begin = np.repeat(tests[part], reps) - group.m
        same = np.ones(len(rows), dtype=bool)
        for k in range(group.m - 1, -1, -1):
            same[same] = group.patterns[rows[same], k] == codes[begin[same] + k]
        yield begin[same], group.items[rows[same]]


def _search(patterns: Patterns, column: pa.Array) -> tuple[np.ndarray, list, list]:
    """For each text of a slice: number of words, hit word positions and items."""
    found = W.words(column, W.ALNUM)
    # Codes of the benchmark's vocabulary; other words get codes that no pattern has.
    known = np.asarray(pa.compute.index_in(found.vocab, patterns.vocab).fill_null(-1), dtype=np.int64)
    codes = known[found.codes] if len(known) else found.codes
    starts, sizes, items = [], [], []
    for group in patterns.groups:
        for begin, item in _occurrences(group, codes, found.bounds):
            starts.append(begin)
            sizes.append(np.full(len(begin), group.m))
            items.append(item)
    hits: list = [[] for _ in range(len(column))]
    names: list = [[] for _ in range(len(column))]
    if starts and sum(map(len, starts)):
        start, size, item = (np.concatenate(x) for x in (starts, sizes, items))
        cover = np.zeros(len(codes) + 1, dtype=np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + size, -1)
        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        low, high = np.searchsorted(hit, found.bounds[:-1]), np.searchsorted(hit, found.bounds[1:])
        for d in np.flatnonzero(high > low):
            hits[d] = hit[low[d] : high[d]] - found.bounds[d]
        pairs = np.unique(np.stack([np.searchsorted(found.bounds, start, side="right") - 1, item], axis=1), axis=0)
        for d, i in pairs.tolist():
            if patterns.item_ids[i] is not None:
                names[d].append(patterns.item_ids[i])
    return found.counts, hits, names


RESULT = "struct<n_words: long, hits: array<int>, items: array<string>>"


def _search_udf(spark, patterns: Patterns):
    shared = spark.sparkContext.broadcast(patterns)

    @F.arrow_udf(RESULT)
    def search(column: pa.Array) -> pa.Array:
        counts, hits, names = [], [], []
        for part in W.slices(column):
            n, h, i = _search(shared.value, part)
            counts += n.tolist()
            hits += h
            names += i
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))],
            ["n_words", "hits", "items"],
        )

    return search


def _chunks(benchmark: DataFrame, chunk_words: int) -> Iterator[list[tuple]]:
    """Benchmark rows in lists whose windows hold at most ``chunk_words`` words, or a single row."""
    rows: list[tuple] = []
    words = 0
    for row in benchmark.select("item_id", "text").dropDuplicates().toLocalIterator():
        more = 10 * (len(row["text"] or "") // 2 + 1)
        if rows and words + more > chunk_words:
            yield rows
            rows, words = [], 0
        rows.append((row["item_id"], row["text"]))
        words += more
    yield rows


def matches(text: Column, benchmark: DataFrame, window: int = 10, chunk_words: int = CHUNK_WORDS) -> Column:
    """``struct(n_words, hits, items)`` of a text column.

    ``hits`` are the positions of the words inside an occurrence, ``items``
    the distinct item ids (as text, sorted) with an occurrence.
    """
    spark = benchmark.sparkSession
    found = [_search_udf(spark, compile_patterns(rows, window))(text) for rows in _chunks(benchmark, chunk_words)]
    hits, items = (
        F.array_sort(F.array_distinct(F.flatten(F.array(*[x.getField(name) for x in found])))) for name in ("hits", "items")
    )
    return F.struct(found[0].getField("n_words").alias("n_words"), hits.alias("hits"), items.alias("items"))


def annotate(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``documents`` with one more column, ``matches``; see there."""
    return documents.withColumn("matches", matches(F.col("text"), benchmark, window))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without a hit word, all columns as they are."""
    found = matches(F.col("text"), benchmark, window)
    return documents.where(F.size(found.getField("hits")) == 0)
