"""Toxicity by cumulative-link ordinal regression.

The model predicts grades ``0 .. K`` from the words of a text: with one weight
for each word, shared by all thresholds, and ordered thresholds ``t_1 < ... <
t_K``, ``P(grade >= k) = sigmoid(w . x - t_k)``.  The expected severity is the
sum of these probabilities over ``k``.

Words: lower-cased runs of letters and digits, and their first 4, 5 and 6
characters where a word is longer (written ``stem-``), which catches words that
are inflected; each present or absent in a text.  Only words that speak for a
grade above 0 in the training texts are features: the ``n_words`` with the
largest likelihood-ratio statistic (G squared) among those in at least
``least`` graded texts and ``LIFT`` times as often in texts above grade 0.
The statistic is counted over all graded texts given, in Spark; at most
``n_words`` words reach the driver.  ``worded`` gives it every labelled text as
its distinct words, so that no whole text is shuffled to its label.

The model alone is fitted to ``fit_rows`` graded texts at most, those with the
smallest hash of their id (``labelled`` takes no more of the labels), as
sparse rows of chosen words on the driver.

``graded`` makes grades from labels that only say toxic or not: 0 for the
latter, and for the former one more than the number of ``CUTS`` passed by the
occurrences of features that mark toxic texts (the first ``marks`` by G
squared, found in toxic texts at least ``MARK_LIFT`` times as often).

Nulls and edge cases: a null text is an empty text and is scored like any
other; a text labelled several times has its highest label; without graded
texts, or with one grade only, every text has that grade (0 if none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.components import staged

N_WORDS = 512
FIT_ROWS = 40_000
MARK_BITS = 1 << 26
CUTS = (2, 4, 8)
LIFT, MARK_LIFT = 3.0, 20.0
STEMS = (4, 5, 6)


def _features_of(found: W.Words) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word number and code of every feature of every word, and what the codes stand for."""
    sizes = np.asarray(pc.utf8_length(found.vocab), dtype=np.int64)
    kinds, owners = [found.vocab], [np.arange(len(sizes))]
    for k in STEMS:
        longer = sizes > k
        cut = pc.utf8_slice_codeunits(found.vocab.filter(pa.array(longer)), 0, k)
        kinds.append(pc.binary_join_element_wise(cut, "-", "") if len(cut) else cut)
        owners.append(np.flatnonzero(longer))
    coded = pa.concat_arrays([x.cast(pa.string()) for x in kinds]).dictionary_encode()
    owner, code = np.concatenate(owners), np.asarray(coded.indices, dtype=np.int64)
    order = np.argsort(owner, kind="stable")
    owner, code = owner[order], code[order]
    first = np.searchsorted(owner, np.arange(len(sizes) + 1))
    reps = np.diff(first)[found.codes]
    word = np.repeat(np.arange(len(found.codes)), reps)
    nth = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    return word, code[np.repeat(first[found.codes], reps) + nth], coded.dictionary


def _distinct(texts: DataFrame) -> DataFrame:
    """``(word, grade, n)``: in how many texts of ``(text, grade)`` a word occurs, by grade."""

    def count(batches):
        for batch in batches:
            at = 0
            for part in W.slices(batch["text"]):
                n = len(part)
                grade = np.asarray(batch["grade"].slice(at, n), dtype=np.int64)
                at += n
                found = W.words(part, W.ALNUM)
                word, code, names = _features_of(found)
                doc = np.repeat(np.arange(n), found.counts)[word]
                size = max(len(names), 1)
                pairs = np.unique(doc * size + code)
                keys, times = np.unique(grade[pairs // size] * size + pairs % size, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(keys % size)), pa.array((keys // size).astype(np.int32)), pa.array(times)],
                    ["word", "grade", "n"],
                )

    found = texts.select("text", "grade").mapInArrow(count, "word string, grade int, n long")
    return found.groupBy("word", "grade").agg(F.sum("n").alias("n"))


def associated(texts: DataFrame, n_words: int = N_WORDS, least: int = 5) -> list[tuple[str, float]]:
    """The words most associated with a grade above 0, best first, and their lift."""
    total = texts.agg(F.count("*").alias("n"), F.count_if(F.col("grade") > 0).alias("pos")).first()
    n, pos = float(total["n"]), float(total["pos"])
    if not pos or pos == n:
        return []
    by_word = (
        _distinct(texts)
        .groupBy("word")
        .agg(F.sum("n").cast("double").alias("all"), F.sum(F.when(F.col("grade") > 0, F.col("n")).otherwise(0)).cast("double").alias("a"))
        .where(F.col("all") >= least)
    )
    a, both = F.col("a"), F.col("all")
    cells = [
        (a, both * pos / n), (both - a, both * (n - pos) / n),
        (F.lit(pos) - a, (F.lit(n) - both) * pos / n), (F.lit(n - pos) - (both - a), (F.lit(n) - both) * (n - pos) / n),
    ]
    g = sum((F.when((o > 0) & (e > 0), 2 * o * F.ln(o / e)).otherwise(0.0) for o, e in cells[1:]),
            F.when((cells[0][0] > 0) & (cells[0][1] > 0), 2 * a * F.ln(a / cells[0][1])).otherwise(0.0))
    lift = (a / pos) / ((both - a + 0.5) / (n - pos))
    best = by_word.select("word", g.alias("g"), lift.alias("lift")).where(F.col("lift") >= LIFT).orderBy(F.desc("g"), "word").limit(n_words)
    return [(r["word"], r["lift"]) for r in best.collect()]


def _vocabulary_rows(column: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, vocabulary index and times of every vocabulary word of a slice."""
    found = W.words(column, W.ALNUM)
    word, code, names = _features_of(found)
    index = np.asarray(pc.index_in(names, vocabulary).fill_null(-1), dtype=np.int64)
    own = index[code] if len(index) else np.zeros(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(column)), found.counts)[word[own >= 0]]
    keys, times = np.unique(doc * len(vocabulary) + own[own >= 0], return_counts=True)
    return keys // max(len(vocabulary), 1), keys % max(len(vocabulary), 1), times


def features(text: Column, vocabulary: list[str]) -> Column:
    """Indexes and times of the vocabulary words in a text."""
    known = pa.array(vocabulary, pa.string())

    @F.arrow_udf("struct<words: array<int>, times: array<int>>")
    def rows(column: pa.Array) -> pa.Array:
        docs, words, times, n = [], [], [], 0
        for part in W.slices(column):
            d, w, t = _vocabulary_rows(part, known)
            docs, words, times, n = [*docs, d + n], [*words, w], [*times, t], n + len(part)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        cut = pa.array(np.searchsorted(cat(docs), np.arange(n + 1)).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(cut, pa.array(cat(x).astype(np.int32))) for x in (words, times)], ["words", "times"]
        )

    return rows(text)


def graded(labelled: DataFrame, found: list[tuple[str, float]], marks: int = 64) -> DataFrame:
    """``labelled(..., text, toxic)`` with ``grade`` in place of ``toxic``; ``found`` are its associated words."""
    own = [w for w, lift in found[:marks] if lift >= MARK_LIFT]
    hits = F.aggregate(features(F.col("text"), own)["times"], F.lit(0), lambda s, x: s + x)
    grade = F.when(F.col("toxic") == 0, 0).otherwise(sum((F.when(hits >= c, 1).otherwise(0) for c in CUTS), F.lit(1)))
    return labelled.withColumn("grade", grade.cast("int")).drop("toxic")


@dataclass
class Model:
    vocabulary: list[str]
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit(rows: list[np.ndarray], grades: np.ndarray, width: int, ridge: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model with a ridge on the weights, by Adam."""
    k = int(grades.max())
    sizes = np.array([len(r) for r in rows])
    index = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    # Thresholds as the first and the logarithms of the gaps, so that they stay ordered.
    above = np.array([(grades >= j).mean() for j in range(1, k + 1)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - above) / above)
    raw = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.05))))
    theta = np.concatenate((np.zeros(width), raw))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, raw = theta[:width], theta[width:]
        gaps = np.exp(raw[1:])
        cuts = np.concatenate(([-np.inf], raw[0] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        z = np.bincount(owner, w[index], len(rows))
        upper, lower = cuts[grades + 1] - z, cuts[grades] - z
        fu, fl = _sigmoid(upper), _sigmoid(lower)
        chance = np.maximum(fu - fl, 1e-12)
        du, dl = fu * (1 - fu) / chance, fl * (1 - fl) / chance
        du[grades == k], dl[grades == 0] = 0, 0
        dz = (du - dl) / len(rows)
        gradient = np.zeros_like(theta)
        gradient[:width] = np.bincount(index, dz[owner], width) + ridge * w
        dcut = np.bincount(grades, -du / len(rows), k + 1)[:k] + np.bincount(grades, dl / len(rows), k + 1)[1:]
        gradient[width] = dcut.sum()
        gradient[width + 1 :] = np.cumsum(dcut[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    raw = theta[width:]
    return theta[:width], raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def fit(
    training: DataFrame,
    found: list[tuple[str, float]] | None = None,
    n_words: int = N_WORDS,
    fit_rows: int = FIT_ROWS,
    ridge: float = 1e-4,
    steps: int = 400,
) -> Model:
    """Fit on ``training(doc_id, text, grade)``; ``found`` are its associated words where they are known."""
    vocabulary = [w for w, _ in (associated(training, n_words) if found is None else found)]
    rows = training.select(
        features(F.col("text"), vocabulary)["words"].alias("words"), "grade",
        F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)).alias("h"),
    )
    own = rows.orderBy("h").limit(fit_rows).select("words", "grade").toArrow()
    grades = own["grade"].to_numpy().astype(np.int64)
    if not len(grades) or grades.min() == grades.max():
        top = int(grades.max()) if len(grades) else 0
        return Model([], np.zeros(0), np.concatenate((np.full(top, -60.0), [60.0])))
    lists = own["words"].combine_chunks()
    cut = np.asarray(lists.offsets)
    parts = np.split(lists.flatten().to_numpy(), (cut[1:-1] - cut[0]))
    weights, thresholds = _fit(parts, grades, len(vocabulary), ridge, steps)
    return Model(vocabulary, weights, thresholds)


def severity(text: Column, model: Model) -> Column:
    """``struct(expected, at_least)``: expected grade, and ``P(grade >= k)`` for ``k`` from 1."""
    known, weights, cuts = pa.array(model.vocabulary, pa.string()), model.weights, model.thresholds

    @F.arrow_udf("struct<expected: double, at_least: array<double>>")
    def grade(column: pa.Array) -> pa.Array:
        out = [np.zeros((0, len(cuts)))]
        for part in W.slices(column):
            doc, word, _ = _vocabulary_rows(part, known)
            z = np.bincount(doc, weights[word], len(part)) if len(word) else np.zeros(len(part))
            out.append(_sigmoid(z[:, None] - cuts[None, :]))
        p = np.concatenate(out)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(cuts)), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(p.sum(axis=1)), lists], ["expected", "at_least"])

    return grade(text)


def _labels(labels: DataFrame) -> DataFrame:
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def worded(documents: DataFrame, labels: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """``(text, grade)`` of all documents with a label, staged: the distinct words of each, and the label.

    The label ids mark ``bits`` bits by hash.  Rows whose id finds no mark have
    no label and stay where they are; with very many labels fewer rows are held
    back, and the join decides in any case.
    """
    own = staged(_labels(labels), "toxicity-labels")
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(bits))
    marks = own.groupBy(F.floor(place / 8).cast("int").alias("byte")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))).alias("marks")
    )
    marks = marks.toArrow()
    held = np.zeros(bits // 8, dtype=np.uint8)
    held[marks["byte"].to_numpy()] = marks["marks"].to_numpy().astype(np.uint8)
    shared = documents.sparkSession.sparkContext.broadcast(held)

    def lists(batches):
        for batch in batches:
            at = np.asarray(batch["place"])
            batch = batch.filter(pa.array((shared.value[at >> 3] >> (at & 7)) & 1 == 1))
            first = 0
            for part in W.slices(batch["text"]):
                n = len(part)
                found = W.words(part, W.ALNUM)
                size = max(len(found.vocab), 1)
                pairs = np.unique(np.repeat(np.arange(n), found.counts) * size + found.codes)
                cut = np.searchsorted(pairs // size, np.arange(n + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(cut), found.vocab.take(pa.array(pairs % size)).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, n), pc.binary_join(words, " ")], ["doc_id", "text"]
                )
                first += n

    id_type = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.where("doc_id IS NOT NULL").select("doc_id", "text", place.alias("place"))
    rows = rows.mapInArrow(lists, f"doc_id {id_type}, text string")
    return staged(rows.join(own, "doc_id").select("text", F.col("toxic").cast("int").alias("grade")), "toxicity-words")


def labelled(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, text, toxic)`` of the documents that the model is fitted to, staged.

    Of the labels, those with the ``fit_rows`` smallest hashes of their id are
    taken, so they can be broadcast at any size and no text is shuffled.
    """
    own = _labels(labels).orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), "doc_id").limit(fit_rows)
    return staged(documents.select("doc_id", "text").join(F.broadcast(own), "doc_id"), "toxicity-labelled")
