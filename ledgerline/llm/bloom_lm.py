"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs of the training texts are counted by their 64-bit hash.
Their counts are quantised on a logarithmic scale (``LEVELS``), and the filter
holds one entry for every level that a count reaches; a count is read back by
probing levels from the first on until one is missing.  Pairs seen less often
than ``min_pair`` are not stored; by default all are.

The filter is cut into segments by hash.  A task builds the segment of its
hashes, the driver only puts segments side by side in a file, and Spark hands
the file to every executor once.  It takes ``BITS_PER_ENTRY`` bits for each
entry however many there are, so scores are as good at any size.  The workers
of an executor map the one file, so no process holds a filter of its own: the
local disk must hold it, and the part of it in use is cached by the system.

With ``c`` the counts read from the filter, a word after another gets

    a * c(pair) / c(before) + (1 - a * r) * (c(word) + 0.1) / (N + 0.1 * (V + 1))

where ``a`` and ``r`` belong to the frequency class of the word before: ``r``
is the share of its following tokens in the training texts whose pair is
stored (1 if all pairs are), which keeps the probabilities summing to one, and
``a`` is the weight that scores a fold of the training texts best when every
token's own occurrence is left out of its pair's count.  Texts begin after an
end token.

Exact word counts, for the base score, come from the same counting: words with
at least a threshold count (the lowest that leaves at most ``head_words``
of them) are broadcast, all others are looked up by a join.  The levels of
these frequent words are probed once, after the filter is built, and broadcast
with them; the words of a text that are not among them are probed in the task.

Nulls and edge cases: a null text is an empty text, one end token; without
training texts all counts are 0.  Rows with one id are scored each on their
own.  A hash stands for its word; two of ten million words share one with a
chance of about three in a million.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.components import staged

PROBES = 3
BITS_PER_ENTRY = 10
FLUSH = 2_000_000
CHUNK = 1 << 16
CLASSES = 40
WEIGHTS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])

END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _levels(growth: float = 1.15, most: float = 1e15) -> np.ndarray:
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * growth)))
    return np.array(out, dtype=np.int64)


LEVELS = _levels()
# What a level stands for: the geometric middle of its counts.
_MIDDLE = np.concatenate(([0.0], np.sqrt(LEVELS * np.append(LEVELS[1:] - 1, LEVELS[-1]).astype(float))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= _A
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds, token codes and the hash of every code of a slice; each text has its end token, whose code is 0."""
    found = W.words(column, W.LOWER)
    table = np.empty(len(found.vocab) + 1, dtype=np.uint64)
    table[0] = END
    table[1:] = np.fromiter(map(xxhash.xxh64_intdigest, W.each(found.vocab)), np.uint64, len(found.vocab))
    ends = found.bounds[1:] + np.arange(1, len(found.bounds))
    out = np.zeros(len(found.codes) + len(column), dtype=np.int64)
    is_word = np.ones(len(out), dtype=bool)
    is_word[ends - 1] = False
    out[is_word] = found.codes + 1
    return np.concatenate(([0], ends)), out, table


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and token hashes of the texts of a slice, each text with its end token."""
    bounds, codes, table = coded(column)
    return bounds, table[codes]


def pairs_of(bounds: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token, and the hash of both."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = END
    return before, _mixed(before * _B + _mixed(tokens ^ _C))


def _slots(hashes: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the rest of the hash of n-grams of an order."""
    if order == 1:
        hashes = _mixed(hashes + _C)
    bits = np.uint64(buckets.bit_length() - 1)
    bucket = (hashes >> (np.uint64(63) - bits) >> np.uint64(1)).astype(np.int64)
    return bucket, (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _positions(keys: np.ndarray, order: int, level: int, probe: int, bits: int) -> np.ndarray:
    """Places in a segment; ``keys`` are those of ``_slots`` multiplied by ``_A``."""
    # Arrays wrap around without a warning.
    seed = np.array([level * PROBES + probe], dtype=np.uint64) * _C + np.array([order], dtype=np.uint64) * _B
    mixed = _mixed(keys + seed)
    # The remainder; numpy divides by a constant much faster than it takes remainders.
    whole = mixed // np.uint64(bits)
    whole *= np.uint64(bits)
    mixed -= whole
    return mixed.view(np.int64)


@dataclass
class Filter:
    """Quantised counts of n-grams; ``bits`` to each of ``buckets`` segments."""

    buckets: int
    bits: int
    data: np.ndarray

    def levels(self, hashes: np.ndarray, order: int) -> np.ndarray:
        """The number of levels found for each hash: 0 for an unknown n-gram."""
        out = np.zeros(len(hashes), dtype=np.int64)
        for start in range(0, len(hashes), CHUNK):
            self._probe(hashes[start : start + CHUNK], order, out[start : start + CHUNK])
        return out

    def _probe(self, hashes: np.ndarray, order: int, out: np.ndarray) -> None:
        bucket, keys = _slots(hashes, order, self.buckets)
        alive, base, keys = np.arange(len(hashes)), bucket * self.bits, keys.astype(np.uint64) * _A
        for level in range(1, len(LEVELS) + 1):
            for probe in range(PROBES):
                at = base + _positions(keys, order, level, probe, self.bits)
                hit = ((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).view(bool)
                if not hit.all():
                    alive, base, keys = alive[hit], base[hit], keys[hit]
            if not len(alive):
                break
            out[alive] = level

    def counts(self, hashes: np.ndarray, order: int) -> np.ndarray:
        # In ascending order, so that probes follow the segments; each n-gram once.
        by = np.argsort(hashes)
        ranked = hashes[by]
        new = np.concatenate((np.ones(min(len(ranked), 1), dtype=bool), ranked[1:] != ranked[:-1]))
        out = np.empty(len(hashes))
        out[by] = np.repeat(_MIDDLE[self.levels(ranked[new], order)], np.diff(np.append(np.flatnonzero(new), len(ranked))))
        return out


_MAPPED: dict[str, np.ndarray] = {}


@dataclass
class Shared:
    """A filter in a file that Spark has added to the session; ``value`` maps it, once in each process."""

    buckets: int
    bits: int
    name: str

    @property
    def value(self) -> Filter:
        if self.name not in _MAPPED:
            # An earlier model's file is not needed by the tasks that come.
            _MAPPED.clear()
            _MAPPED[self.name] = np.memmap(os.path.abspath(SparkFiles.get(self.name)), dtype=np.uint8, mode="r")
        return Filter(self.buckets, self.bits, _MAPPED[self.name])


def _share(spark: SparkSession, filter: Filter) -> Shared:
    """``filter``, whose data ``_build`` has put into a file of the session, for the workers."""
    path = str(filter.data.filename)
    spark.sparkContext.addFile(path)
    return Shared(filter.buckets, filter.bits, os.path.basename(path))


@dataclass
class Head:
    """The most frequent words by ascending hash: their exact counts, and their levels as the filter gives them."""

    keys: np.ndarray
    counts: np.ndarray
    levels: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash, and whether it is there."""
        place = np.searchsorted(self.keys, hashes)
        place[place == len(self.keys)] = 0
        return place, self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), dtype=bool)


@dataclass
class Model:
    """``filter`` is a ``Filter`` in a shared file and ``head`` a broadcast ``Head``; all else is small."""

    tokens: int
    types: int
    filter: Shared
    head: Broadcast
    weight: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    stored: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    min_pair: int = 1

    def word_levels(self, hashes: np.ndarray, found=None) -> np.ndarray:
        """Levels of words: those of the head are known, all others are probed."""
        head = self.head.value
        place, known = found or head.find(hashes)
        out = np.empty(len(hashes), dtype=np.int64)
        out[known] = head.levels[place[known]]
        out[~known] = self.filter.value.levels(hashes[~known], 1)
        return out

    def parts(self, bounds, codes, table=None, leave_out: bool = False, found=None):
        """Word probability, class of the word before, and the pair's share of it for every token.

        The words of a slice are looked up once each, and taken by code; without a table the codes are
        token hashes themselves.  ``found`` is where the head has the words of the table, if that is known.
        """
        if table is None:
            table, codes = np.concatenate(([END], codes)), np.arange(1, len(codes) + 1)
        own = _MIDDLE[self.word_levels(table, found)]
        _, pairs = pairs_of(bounds, table[codes])
        counts = own[codes]
        first = np.empty_like(counts)
        first[1:] = counts[:-1]
        if len(bounds) > 1:
            first[bounds[:-1]] = own[0]
        pair = np.minimum(self.filter.value.counts(pairs, 2), first)
        if leave_out:
            # Without its own occurrence a pair at min_pair would not be stored.
            pair = np.where(pair >= self.min_pair + 1, pair - 1, 0)
        word = (counts + 0.1) / (self.tokens + 0.1 * (self.types + 1))
        kind = np.minimum(np.log2(first + 1).astype(np.int64), CLASSES - 1)
        return word, kind, pair / np.maximum(first - (1 if leave_out else 0), 1)

    def probabilities(self, bounds, codes, table=None, found=None) -> np.ndarray:
        word, kind, share = self.parts(bounds, codes, table, found=found)
        a = self.weight[kind]
        return a * share + (1 - a * self.stored[kind]) * word


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def word_counts(texts: DataFrame) -> DataFrame:
    """``(h, c)`` for every distinct token of a one-column table of texts."""

    def count(batches):
        held: list[np.ndarray] = []
        size = 0

        def out():
            keys, counts = _summed(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "c"])

        for batch in batches:
            for part in W.slices(batch.column(0)):
                held.append(hashed(part)[1])
                size += len(held[-1])
                if size >= FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return texts.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


GRAMS = "bucket int, size int, keys binary, counts binary, entries long"


def _blocks(hashes: np.ndarray, counts: np.ndarray, order: int, buckets: int) -> pa.RecordBatch:
    bucket, keys = _slots(hashes, order, buckets)
    counts = counts.astype(np.uint64)
    # Pairs in ascending order are in order of their buckets already.
    if (bucket[1:] < bucket[:-1]).any():
        by = np.argsort(bucket, kind="stable")
        bucket, keys, counts = bucket[by], keys[by], counts[by]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, int)
    ends = np.append(starts[1:], len(bucket))
    levels = np.searchsorted(LEVELS, counts.astype(np.int64), side="right")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[starts].astype(np.int32)),
            pa.array(np.full(len(starts), order, dtype=np.int32)),
            pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            pa.array([int(levels[a:b].sum()) for a, b in zip(starts, ends)], pa.int64()),
        ],
        ["bucket", "size", "keys", "counts", "entries"],
    )


def _word_blocks(counted: DataFrame, buckets: int) -> DataFrame:
    def pack(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            held.append((np.asarray(batch["h"]).view(np.uint64), np.asarray(batch["c"])))
            size += batch.num_rows
            if size >= FLUSH:
                yield _blocks(*(np.concatenate(x) for x in zip(*held)), 1, buckets)
                held, size = [], 0
        if held:
            yield _blocks(*(np.concatenate(x) for x in zip(*held)), 1, buckets)

    return counted.mapInArrow(pack, GRAMS)


def _pair_blocks(texts: DataFrame, buckets: int, least: int) -> DataFrame:
    def count(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in W.slices(batch.column(0)):
                held.append(pairs_of(*hashed(part))[1])
                size += len(held[-1])
                if size >= FLUSH:
                    yield _blocks(*_summed(np.concatenate(held)), 2, buckets)
                    held, size = [], 0
        if held:
            yield _blocks(*_summed(np.concatenate(held)), 2, buckets)

    def merge(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table["counts"].to_pylist()])
        keys, counts = _summed(keys, counts)
        some = counts >= least
        keys, counts = keys[some], counts[some]
        entries = int(np.searchsorted(LEVELS, counts.astype(np.int64), side="right").sum())
        row = [table["bucket"][0].as_py(), 2, keys.tobytes(), counts.tobytes(), entries]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
        names = ["bucket", "size", "keys", "counts", "entries"]
        return pa.table([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

    return texts.mapInArrow(count, GRAMS).groupBy("bucket").applyInArrow(merge, GRAMS)


def _build(grams: DataFrame, buckets: int, bits: int) -> np.memmap:
    """The segments side by side, in a file among those of the session."""

    def segment(table: pa.Table) -> pa.Table:
        own = np.zeros(bits, dtype=bool)
        for size in (1, 2):
            rows = table.filter(pc.equal(table["size"], size))
            keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), dtype=np.uint32)
            counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), dtype=np.uint64)
            reached = np.searchsorted(LEVELS, counts.astype(np.int64), side="right")
            keys = keys.astype(np.uint64) * _A
            for level in range(1, int(reached.max(initial=0)) + 1):
                keys, reached = keys[reached >= level], reached[reached >= level]
                for probe in range(PROBES):
                    own[_positions(keys, size, level, probe, bits)] = True
        packed = np.packbits(own, bitorder="little").tobytes()
        return pa.table([pa.array([table["bucket"][0].as_py()], pa.int32()), pa.array([packed], pa.binary())], names=["bucket", "bits"])

    # Spark removes this folder with the session.
    path = os.path.join(SparkFiles.getRootDirectory(), f"lm-filter-{uuid.uuid4().hex}")
    out = np.memmap(path, dtype=np.uint8, mode="w+", shape=(buckets * bits // 8,))
    segments = staged(grams.groupBy("bucket").applyInArrow(segment, "bucket int, bits binary"), "lm-segments")
    for row in segments.toLocalIterator():
        at = row["bucket"] * (bits // 8)
        out[at : at + bits // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    out.flush()
    return out


def _added(texts: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all tasks of ``partial(bounds, codes, table)``."""

    def each(batches):
        total = np.zeros(size)
        for batch in batches:
            for part in W.slices(batch.column(0)):
                total += partial(*coded(part))
        yield pa.RecordBatch.from_arrays([pa.array(range(size)), pa.array(total)], ["i", "x"])

    out = np.zeros(size)
    for row in texts.mapInArrow(each, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[row["i"]] = row["x"]
    return out


def fit(
    training: DataFrame, tuning: Column, counted: DataFrame, min_pair: int = 1, head_words: int = 1 << 20
) -> Model:
    """Fit on ``training(text)``; ``tuning`` selects the fold of it that sets the weights; ``counted`` is its word count."""
    spark = training.sparkSession
    row = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, types = int(row["n"]), int(row["v"])
    # About half a million tokens to a bucket, so that a bucket fits a task at any size.
    buckets = 1 << max(6, int(np.ceil(np.log2(max(tokens, 1) / (1 << 19)))))
    texts = training.select("text")
    grams = staged(_word_blocks(counted, buckets).unionByName(_pair_blocks(texts, buckets, min_pair)), "lm-grams")
    entries = int(grams.agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).first()["n"])
    bits = -(-max(1 << 20, entries * BITS_PER_ENTRY) // (buckets * 64)) * 64
    built = Filter(buckets, bits, _build(grams, buckets, bits))
    keys, exact, _ = _head(counted, head_words)
    head = spark.sparkContext.broadcast(Head(keys, exact, built.levels(keys, 1).astype(np.int16)))
    shared = _share(spark, built)
    del built
    model = Model(tokens, types, shared, head, min_pair=min_pair)
    fold = training.where(tuning).select("text")

    def seen(*own):
        _, kind, share = model.parts(*own)
        return np.concatenate((np.bincount(kind, minlength=CLASSES), np.bincount(kind, share > 0, CLASSES)))

    if min_pair > 1:
        counts = _added(texts, seen, 2 * CLASSES)
        stored = counts[CLASSES:] / np.maximum(counts[:CLASSES], 1)
    else:
        # The filter finds whatever is in it, and every pair of the training texts is.
        stored = np.ones(CLASSES)

    def likelihood(*own):
        word, kind, share = model.parts(*own, leave_out=True)
        return np.concatenate(
            [np.bincount(kind, np.log(a * share + (1 - a * stored[kind]) * word), CLASSES) for a in WEIGHTS]
        )

    best = _added(fold, likelihood, CLASSES * len(WEIGHTS)).reshape(len(WEIGHTS), CLASSES).argmax(axis=0)
    return Model(tokens, types, shared, head, WEIGHTS[best], stored, min_pair)


def _head(counted: DataFrame, head_words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The words whose count is at least the lowest threshold that at most ``head_words`` of them reach."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r["level"]: r["n"] for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, words = 63, 0
    while least > 0 and words + sizes.get(least - 1, 0) <= head_words:
        least -= 1
        words += sizes.get(least, 0)
    # At most head_words rows.
    own = counted.where(F.col("c") >= F.lit(1 << least).cast("long")).toArrow()
    keys = own["h"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], own["c"].to_numpy()[order], least


def score(documents: DataFrame, training: Column, tuning: Column, **options) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score, training)`` for ``documents(doc_id, text)``.

    ``training`` says which rows the counts come from; ``tuning`` which of
    them set the weights; ``options`` are those of ``fit``.
    """
    rows = documents.select("doc_id", "text", training.alias("training"), tuning.alias("tuning"))
    own = rows.where("training")
    counted = staged(word_counts(own.select("text")), "lm-words")
    model = fit(own, F.col("tuning"), counted, **options)
    norm = model.tokens + 0.1 * (model.types + 1)

    def scored(batches: Iterator[pa.RecordBatch]):
        head = model.head.value
        for batch in batches:
            at = 0
            for part in W.slices(batch["text"]):
                bounds, codes, table = coded(part)
                n = len(part)
                # Each word of the slice is looked up once.
                place, in_head = head.find(table)
                logs_of = np.zeros(len(table))
                logs_of[in_head] = np.log10((head.counts[place[in_head]] + 0.1) / norm)
                known, base = in_head[codes], logs_of[codes]
                doc = np.repeat(np.arange(n), np.diff(bounds))
                pairs, times = np.unique(doc[~known] * len(table) + codes[~known], return_counts=True)
                cut = np.searchsorted(pairs // len(table), np.arange(n + 1)).astype(np.int32)
                rare = table[pairs % len(table)]
                logs = np.log10(model.probabilities(bounds, codes, table, (place, in_head)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, n),
                        batch["training"].slice(at, n),
                        pa.array(np.diff(bounds)),
                        pa.array(W.sums(known.astype(np.int64), bounds)),
                        pa.array(np.bincount(doc, base, n)),
                        pa.array(np.bincount(doc, logs, n)),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(rare.view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(times)),
                    ],
                    names,
                )
                at += n

    id_type = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "training", "n_tokens", "n_head", "head_score", "score", "rare", "times"]
    schema = (
        f"doc_id {id_type}, training boolean, n_tokens long, n_head long, head_score double, score double, "
        "rare array<long>, times array<long>"
    )
    found = rows.select("doc_id", "training", "text").mapInArrow(scored, schema)
    found = staged(found.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    rare = found.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("h"), F.col("w.times").alias("times"))
    rare = rare.join(counted, "h", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(norm))).alias("rare_score"),
    )
    return found.join(rare, "row", "left").select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )
