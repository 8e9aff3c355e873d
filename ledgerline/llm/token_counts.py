"""Tokens of whole texts, counted by distinct pre-tokens and without their ids.

A BPE merge joins two symbols only if the result is a piece, so nothing ever
merges across two characters that stand side by side in no piece.  ``Cutter``
cuts there: the pre-tokens of a text are encoded independently of each other,
and the number of its tokens is the sum of theirs.

1. Every task counts the pre-tokens of its texts, and one aggregate gives every
   distinct pre-token of the corpus with its frequency.
2. The library encodes each of them once; only the number of pieces is kept.
3. Pre-tokens that reach a threshold frequency (the lowest that leaves at most
   ``head_words`` of them of at most ``LONGEST`` bytes) are broadcast, and a
   task sums them up at once.  Per-document frequencies of all others are
   joined to the counts.  No key of that join holds more than a
   ``head_words``-th of the corpus.

Takes BPE models with byte fallback and no normalisation but the space mark;
others raise a ``ValueError``.

Nulls and edge cases: a null text is an empty text, which has no tokens; a null
id stays null; repeated rows are counted each on their own; an empty table
gives an empty table.  A long text is counted in parts, so memory follows the
slice and the longest pre-token.  Columns other than the id and the text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import cuts, pieces
from ledgerline.llm import words as W
from ledgerline.llm.components import staged

SLICE = 2 << 20
#: Distinct pre-tokens held by a task before they are sent on, and their bytes.
FLUSH_WORDS, FLUSH_BYTES = 500_000, 16 << 20
#: Bytes of a pre-token that may be broadcast.
LONGEST = 64
OTHER = 128
BPE = 2


def _class(char: str) -> int:
    return 32 if char == "▁" else ord(char) if ord(char) < 128 else OTHER


class Cutter:
    """Where a model's pieces never reach across, by the classes (ASCII byte or other) of two neighbours."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        info = pieces.read_model(data)
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        ids = range(model.get_piece_size())
        kind = next((v for n, x, _, _ in pieces._fields(data) if n == 2 for m, v, _, _ in pieces._fields(x) if m == 3), 1)
        simple = pieces.Normalizer(info).simple and info.add_dummy_prefix and info.escape_whitespaces
        if kind != BPE or not simple or info.space_as_suffix or not any(map(model.is_byte, ids)):
            raise ValueError("pre-tokens need a BPE model with byte fallback and no normalisation but the space mark")
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=info.plain)
        joined = np.zeros((129, 129), dtype=bool)
        for i in ids:
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                own = model.id_to_piece(i)
                for a, b in zip(own, own[1:]):
                    joined[_class(a), _class(b)] = True
        # Bytes of one character stay together, and its parts may look like a space mark.
        joined[OTHER, OTHER] = True
        self.joined = joined
        # Where a text holds the mark itself, any character that is not ASCII may be one.
        self.marked = joined.copy()
        self.marked[OTHER] |= joined[32]
        self.marked[:, OTHER] |= joined[:, 32]
        self.marked[32, OTHER] = self.marked[OTHER, 32] = True

    def cut(self, data: np.ndarray) -> np.ndarray:
        table = self.marked if pieces.SPACE in data.tobytes() else self.joined
        kinds = np.minimum(data, OTHER).astype(np.int32)
        out = np.zeros(len(data), dtype=bool)
        if len(data) > 1:
            out[1:] = ~table.ravel()[kinds[:-1] * 129 + kinds[1:]]
        return out

    def n_pieces(self, words: list[bytes]) -> list[int]:
        marked = [w.decode().replace(" ", "▁") for w in words]
        return [len(x) for x in self.plain.encode(marked, return_type="numpy", num_threads=1)]


_CUTTERS: dict[str, Cutter] = {}


def cutter(path: str) -> Cutter:
    if path not in _CUTTERS:
        _CUTTERS[path] = Cutter(path)
    return _CUTTERS[path]


def pre_tokens(texts: DataFrame, path: str) -> DataFrame:
    """``(word binary, c long)``: every distinct pre-token of a one-column table of texts and its frequency."""

    def count(batches):
        own = cutter(path)
        held: list[pa.Table] = []
        rows = size = 0

        def out():
            table = pa.concat_tables(held).group_by("word").aggregate([("c", "sum")])
            table = table.select(["word", "c_sum"]).rename_columns(["word", "c"]).combine_chunks()
            return table.to_batches(max_chunksize=50_000)

        for batch in batches:
            for _, _, _, block in cuts.blocks(batch.column(0), own.cut, SLICE):
                found = cuts.coded(block, own.cut)
                counts = np.bincount(found.codes, minlength=len(found.vocab))
                held.append(pa.table({"word": found.vocab, "c": counts}))
                rows, size = rows + len(found.vocab), size + found.vocab.nbytes
                if rows >= FLUSH_WORDS or size >= FLUSH_BYTES:
                    yield from out()
                    held, rows, size = [], 0, 0
        if held:
            yield from out()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def sized(counted: DataFrame, path: str) -> DataFrame:
    """``(word, c, n)``: with the number of pieces of every pre-token, each encoded once."""

    def encode(batches):
        own = cutter(path)
        for batch in batches:
            n = own.n_pieces(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["c"], pa.array(n, pa.int64())], ["word", "c", "n"])

    return counted.mapInArrow(encode, "word binary, c long, n long")


def count_tokens(documents: DataFrame, path: str, head_words: int = 1 << 18) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for ``documents(doc_id, text)``, without begin and end tokens."""
    spark = documents.sparkSession
    rows = documents.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    ).withColumn("row", F.monotonically_increasing_id())
    # An empty text has no token, not even that of the space before it.
    full = documents.where(F.octet_length("text") > 0).select("text")
    counted = staged(sized(pre_tokens(full, path), path), "token-words")
    short = counted.where(F.octet_length("word") <= LONGEST)
    # At most head_words rows of at most LONGEST bytes.
    head = short.where(cuts.frequent(short, "c", head_words)).select("word", "n").toArrow()
    shared = spark.sparkContext.broadcast((head["word"].combine_chunks(), head["n"].to_numpy()))

    def summed(batches: Iterator[pa.RecordBatch]):
        own = cutter(path)
        keys, sizes = shared.value
        for batch in batches:
            done = -1
            for at, n, _, block in cuts.blocks(batch["text"], own.cut, SLICE):
                found = cuts.coded(block, own.cut)
                place = pc.index_in(found.vocab, value_set=keys)
                known = np.asarray(place.is_valid())
                place = np.asarray(pc.fill_null(place, 0))
                size = np.where(known, sizes[place], 0) if len(sizes) else np.zeros(len(known), dtype=np.int64)
                doc = np.repeat(np.arange(n), np.diff(found.bounds))
                n_bytes = np.asarray(batch["n_bytes"].slice(at, n))
                full = np.repeat(n_bytes > 0, np.diff(found.bounds))
                rare = full & ~known[found.codes]
                pairs, times = np.unique(doc[rare] * (len(known) + 1) + found.codes[rare], return_counts=True)
                cut = np.searchsorted(pairs // (len(known) + 1), np.arange(n + 1)).astype(np.int32)
                rare_words = found.vocab.take(pa.array(pairs % (len(known) + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(at, n),
                        batch["doc_id"].slice(at, n),
                        # A long text counts its bytes with its first part.
                        pa.array(n_bytes if at != done else np.zeros(n, dtype=np.int64)),
                        pa.array(W.sums(np.where(full, size[found.codes], 0), found.bounds)),
                        pa.ListArray.from_arrays(pa.array(cut), rare_words),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int64))),
                    ],
                    names,
                )
                done = at

    id_type = documents.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_bytes", "n_tokens", "rare", "times"]
    schema = f"row long, doc_id {id_type}, n_bytes long, n_tokens long, rare array<binary>, times array<long>"
    found = staged(rows.select("row", "doc_id", "n_bytes", "text").mapInArrow(summed, schema), "token-sums")
    rare = found.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    tail = rare.join(counted.select("word", "n"), "word").select(
        "row", F.lit(None).cast(id_type).alias("doc_id"), F.lit(0).cast("long").alias("n_bytes"),
        (F.col("times") * F.col("n")).alias("n_tokens"),
    )
    total = found.select("row", "doc_id", "n_bytes", "n_tokens").unionByName(tail).groupBy("row")
    return total.agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")
    ).drop("row")
