"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all other training documents,
whatever they are, are unlabelled.  With class prior ``p`` the risk of a
linear scorer ``g`` under logistic loss is

    p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)])

(the part in ``max`` estimates the risk on negatives and cannot really be
negative).  While that part is positive a Newton step minimises the whole
risk, which is convex for this loss; when it is negative, the step goes
against that part only, as the non-negative estimator asks.

The class prior is estimated from the data: a first logistic regression
separates positives from unlabelled documents; over all thresholds of its
score, the share of unlabelled documents above the threshold is at least
``p`` times the share of positives above it, and the smallest ratio (with a
binomial confidence margin) is the estimate.

Features are shapes of the whole text, not its words: shares of byte classes
and of pairs of neighbouring classes, repeated neighbouring words, distinct
words, the commonest word, word lengths, repeated lines, each also as a
square root.  All sums run over all training documents in Spark; what reaches
the driver is a few sums of the number of features squared.

A text longer than ``SLICE`` is taken in blocks: its counts are added up, and
different words and lines are told apart by 64-bit hashes (16 bytes each), so
memory grows with the distinct words and lines of a text, not with its length.
A single word is always taken whole.

Nulls and edge cases: a null text is an empty text and is scored like any
other; a document labelled both good and bad is no trusted positive; labels
without a document or with a null id are not used; without any positive or any
unlabelled training document every score is the prior given.  Repeated rows
count as often as they occur, in fitting and in the result; an empty table has
no scores; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.components import staged

# Classes of bytes: white space, lower, upper, digit, sentence marks, other
# punctuation, bar, non-ASCII.
_CLASS = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        7 if _b >= 128 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit()
        else 4 if _c in ".,;:'\"?-()" else 6 if _c == "|" else 0 if _b <= 32 else 5
    )
CLASSES = 8
N_SHAPES = CLASSES + CLASSES * CLASSES + 6
N_FEATURES = 1 + 2 * N_SHAPES

# Text looked at at once: every byte of it takes some 60 bytes of work space.
SLICE = 1 << 18

# Sums of partitions are added up in so many groups before the driver adds those.
GROUPS = 32


def _shapes(column: pa.Array) -> np.ndarray:
    """One row of ``N_SHAPES`` for every text of a slice."""
    n = len(column)
    shapes = np.zeros((n, N_SHAPES), dtype=np.float64)
    ends = W._offsets(column).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = ends - ends[0]
    size = np.diff(bounds)
    doc = np.repeat(np.arange(n), size)
    kind = _CLASS[raw].astype(np.int64)
    at = CLASSES
    shapes[:, :at] = np.bincount(doc * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    shapes[:, :at] /= np.maximum(size, 1)[:, None]
    pairs = kind[:-1] * CLASSES + kind[1:]
    same = doc[:-1] == doc[1:]
    square = CLASSES * CLASSES
    shapes[:, at : at + square] = np.bincount(
        doc[:-1][same] * square + pairs[same], minlength=n * square
    ).reshape(n, square)
    shapes[:, at : at + square] /= np.maximum(size - 1, 1)[:, None]
    at += square
    found = W.words(column, W.LOWER)
    count = np.maximum(found.counts, 1)
    owner = np.repeat(np.arange(n), found.counts)
    equal = np.zeros(len(found.codes), dtype=np.int64)
    if len(equal) > 1:
        equal[1:] = (found.codes[1:] == found.codes[:-1]) & (owner[1:] == owner[:-1])
    shapes[:, at] = W.sums(equal, found.bounds) / count
    own, times = np.unique(owner * (len(found.vocab) + 1) + found.codes, return_counts=True)
    own //= len(found.vocab) + 1
    distinct = np.bincount(own, minlength=n)
    shapes[:, at + 1] = distinct / count
    most = np.zeros(n)
    np.maximum.at(most, own, times)
    shapes[:, at + 2] = most / count
    shapes[:, at + 3] = np.minimum(size / count, 40) / 40
    lines = pc.split_pattern(column, "\n")
    flat = lines.flatten().dictionary_encode()
    line_bounds = np.asarray(lines.offsets) - lines.offsets[0].as_py()
    line_doc = np.repeat(np.arange(n), np.diff(line_bounds))
    different = np.unique(line_doc * (len(flat.dictionary) + 1) + np.asarray(flat.indices, dtype=np.int64))
    per_doc = np.maximum(np.diff(line_bounds), 1)
    shapes[:, at + 4] = 1 - np.bincount(different // (len(flat.dictionary) + 1), minlength=n) / per_doc
    shapes[:, at + 5] = np.log1p(size) / 16
    return shapes


class _Different:
    """Different strings of a stream by hash, and how often each came."""

    def __init__(self):
        self.keys, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list = []
        self.n_new = 0

    def add(self, hashes: np.ndarray, times: np.ndarray) -> None:
        self.new.append((hashes, times))
        self.n_new += len(hashes)
        # Merged when as many are new as are known: every key is merged a logarithmic number of times.
        if self.n_new > max(len(self.keys), 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(x[0] for x in self.new)])
        times = np.concatenate([self.times, *(x[1] for x in self.new)])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.times = np.bincount(at, times, len(self.keys)).astype(np.int64)
        self.new, self.n_new = [], 0


def _hash(strings) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64)


def _shapes_in_blocks(column: pa.Array, block: int) -> np.ndarray:
    """``_shapes`` of a single text, looked at in blocks of about ``block`` bytes."""
    square = CLASSES * CLASSES
    kinds, pairs = np.zeros(CLASSES, np.int64), np.zeros(square, np.int64)
    words, lines = _Different(), _Different()
    size = n_words = equal = n_lines = 0
    last = before = None
    line = xxhash.xxh3_64()
    for part in W.blocks(column, block):
        raw = np.frombuffer(part.buffers()[2], dtype=np.uint8)
        size += len(raw)
        for at in range(0, len(raw), block):
            kind = _CLASS[raw[at : at + block]].astype(np.int64)
            kinds += np.bincount(kind, minlength=CLASSES)
            pairs += np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=square)
            if last is not None:
                pairs[last * CLASSES + kind[0]] += 1
            last = kind[-1]
        found = W.words(part, W.LOWER)
        if len(found.codes):
            n_words += len(found.codes)
            equal += int((found.codes[1:] == found.codes[:-1]).sum()) + int(found.vocab[found.codes[0]].as_py() == before)
            before = found.vocab[found.codes[-1]].as_py()
            words.add(_hash(W.each(found.vocab)), np.bincount(found.codes, minlength=len(found.vocab)))
        # A line may go on in the next block.
        cut = raw.tobytes().split(b"\n")
        line.update(cut[0])
        if len(cut) > 1:
            n_lines += len(cut) - 1
            own = np.concatenate((np.array([line.intdigest()], np.uint64), _hash(cut[1:-1])))
            lines.add(*np.unique(own, return_counts=True))
            line = xxhash.xxh3_64(cut[-1])
    lines.add(np.array([line.intdigest()], np.uint64), np.ones(1, np.int64))
    words.merge()
    lines.merge()
    count = max(n_words, 1)
    rest = [
        equal / count, len(words.keys) / count, words.times.max(initial=0) / count,
        min(size / count, 40) / 40, 1 - len(lines.keys) / (n_lines + 1), np.log1p(size) / 16,
    ]
    return np.concatenate((kinds / max(size, 1), pairs / max(size - 1, 1), rest))


def features(column: pa.Array, block: int = SLICE) -> np.ndarray:
    """One row of ``N_FEATURES`` for every text of a slice; a single long text is taken in blocks."""
    if len(column) == 1 and W.text_bytes(column) > block:
        shapes = _shapes_in_blocks(column, block)[None, :]
    else:
        shapes = _shapes(column)
    return np.concatenate((np.ones((len(column), 1)), shapes, np.sqrt(np.maximum(shapes, 0))), axis=1)


@dataclass
class Model:
    weights: np.ndarray
    prior: float


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, N_FEATURES).astype(np.float64)


def feature_column(text: Column) -> Column:
    """Features packed as 32-bit floats."""

    @F.arrow_udf("binary")
    def shapes(column: pa.Array) -> pa.Array:
        out: list = []
        for part in W.slices(column, SLICE):
            out += [x.tobytes() for x in features(part).astype("<f4")]
        return pa.array(out, pa.binary())

    return shapes(text)


def _added(rows: DataFrame, partial, size: int) -> np.ndarray:
    """The sum of ``partial(matrix, positive)`` over all ``rows(x, positive)``."""

    def each(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += partial(_matrix(batch["x"]), np.asarray(batch["positive"]))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def group(batches):
        total = np.zeros(size)
        for batch in batches:
            for x in batch["total"].to_pylist():
                total += np.frombuffer(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    sums = rows.select("x", "positive").mapInArrow(each, "total binary")
    sums = sums.repartition(GROUPS, F.spark_partition_id()).mapInArrow(group, "total binary")
    return sum((np.frombuffer(r["total"]) for r in sums.collect()), np.zeros(size))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _upper(h: np.ndarray) -> np.ndarray:
    return h[np.triu_indices(N_FEATURES)]


def _full(values: np.ndarray) -> np.ndarray:
    out = np.zeros((N_FEATURES, N_FEATURES))
    out[np.triu_indices(N_FEATURES)] = values
    return out + np.triu(out, 1).T


def _fit(rows: DataFrame, objective, steps: int, ridge: float) -> np.ndarray:
    """Newton steps for ``objective(weights)``, which returns partial sums and a function from their total to a step's parts."""
    weights = np.zeros(N_FEATURES)
    for _ in range(steps):
        partial, size, parts = objective(weights)
        gradient, hessian = parts(_added(rows, partial, size))
        penalty = np.full(N_FEATURES, ridge)
        penalty[0] = ridge / 100
        step = np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * weights)
        step *= min(1.0, 20 / max(np.abs(step).max(), 1e-12))
        weights = weights - step
        if np.abs(step).max() < 1e-3:
            break
    return weights


def _contrast(n_pos: int, n_unl: int):
    """Balanced logistic regression of positives against unlabelled."""

    def objective(w):
        def partial(x, positive):
            q = _sigmoid(x @ w)
            share = np.where(positive, 0.5 / n_pos, 0.5 / n_unl)
            curve = (x * (share * q * (1 - q))[:, None]).T @ x
            return np.concatenate((x.T @ (share * (q - positive)), _upper(curve)))

        return partial, N_FEATURES + N_FEATURES * (N_FEATURES + 1) // 2, lambda t: (t[:N_FEATURES], _full(t[N_FEATURES:]))

    return objective


def _nonnegative(n_pos: int, n_all: int, prior: float):
    """The non-negative risk; the unlabelled sample holds all training documents, positives too."""

    def objective(w):
        d = N_FEATURES

        def partial(x, positive):
            z = x @ w
            q = _sigmoid(z)
            good = x[positive]
            qg = q[positive]
            loss = np.logaddexp(0, z)
            return np.concatenate(
                (
                    x.T @ q / n_all, good.T @ qg / n_pos, good.sum(axis=0) / n_pos,
                    _upper((x * (q * (1 - q) / n_all)[:, None]).T @ x),
                    _upper((good * (qg * (1 - qg) / n_pos)[:, None]).T @ good),
                    [loss.sum() / n_all, loss[positive].sum() / n_pos],
                )
            )

        def parts(t):
            m = d * (d + 1) // 2
            unl, pos, mean = t[:d], t[d : 2 * d], t[2 * d : 3 * d]
            h_unl, h_pos = _full(t[3 * d : 3 * d + m]), _full(t[3 * d + m : 3 * d + 2 * m])
            negative = t[-2] - prior * t[-1]
            if negative >= 0:
                # The curvature of the whole risk is that of the unlabelled part.
                return unl - prior * mean, h_unl
            return 0.1 * (prior * pos - unl), h_unl + prior * h_pos

        return partial, 3 * d + d * (d + 1) + 2, parts

    return objective


def _estimated_prior(rows: DataFrame, weights: np.ndarray, n_pos: int, n_all: int, bins: int = 1000) -> float:
    """The smallest upper bound of the prior over all thresholds of the contrast score."""

    def partial(x, positive):
        at = np.minimum((_sigmoid(x @ weights) * bins).astype(int), bins - 1)
        return np.concatenate((np.bincount(at[positive], minlength=bins), np.bincount(at, minlength=bins))).astype(float)

    counts = _added(rows, partial, 2 * bins)
    pos = np.cumsum(counts[:bins][::-1])[::-1] / n_pos
    unl = np.cumsum(counts[bins:][::-1])[::-1] / n_all
    margin = np.sqrt(np.log(20 * bins) / 2 / n_pos) + np.sqrt(np.log(20 * bins) / 2 / n_all)
    bound = (unl + margin) / np.maximum(pos, 1e-9)
    best = int(np.argmin(np.where(pos > 0.01, bound, np.inf)))
    return float(np.clip(unl[best] / max(pos[best], 1e-9), 0.01, 0.99))


def fit(
    training: DataFrame, positives: DataFrame, steps: int = 12, ridge: float = 1e-4, prior: float | None = None
) -> Model:
    """Fit on all ``training(doc_id, text)``; ``positives(doc_id)`` names the trusted ones.

    ``prior`` fixes the class prior; by default it is estimated.
    """
    shapes = training.select("doc_id", feature_column(F.col("text")).alias("x"))
    trusted = positives.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("positive", F.lit(True))
    rows = shapes.join(trusted, "doc_id", "left").select("x", F.coalesce("positive", F.lit(False)).alias("positive"))
    rows = staged(rows, "quality-features")
    n = rows.agg(F.count("*").alias("n"), F.count_if("positive").alias("pos")).first()
    if not n["pos"] or n["n"] == n["pos"]:
        flat = np.zeros(N_FEATURES)
        known = prior if prior is not None else 0.5
        flat[0] = np.log(known / (1 - known))
        return Model(flat, known)
    if prior is None:
        first = _fit(rows, _contrast(n["pos"], n["n"] - n["pos"]), max(2, steps // 2), ridge)
        prior = _estimated_prior(rows, first, n["pos"], n["n"])
    return Model(_fit(rows, _nonnegative(n["pos"], n["n"], prior), steps, ridge), prior)


def score(text: Column, model: Model) -> Column:
    """Probability that a text is good."""
    weights = model.weights

    @F.arrow_udf("double")
    def probability(column: pa.Array) -> pa.Array:
        parts = [_sigmoid(features(x) @ weights) for x in W.slices(column, SLICE)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return probability(text)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids whose every label is good."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
