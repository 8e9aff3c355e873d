"""Two tokenizers of one text, aligned by the bytes their tokens cover.

A byte-level BPE (A, on a space and the text) and a piece model (B, which puts
the space itself) both tile the same bytes.  Where a token of A and a token of
B end at the same byte a group ends; every pair of tokens that share a byte is
a link, and links are counted by the ids of their ends over the whole corpus.

Character offsets of A and the spans of B's proto are coarse cuts: a token
that ends where the next begins ends at a known byte.  Tokens that share a
character (bytes of a longer character in A, byte pieces in B) have one span
or none of their own; between two coarse cuts their ends are refined with the
decoded bytes of each token.  A word whose decoded bytes differ from its own
has no alignment, and neither has the text that holds it.

Texts are cut into words before white space that follows other characters.
Neither tokenizer joins across such a place (checked on loading: the standard
byte-level pattern in A, no piece with a space mark after another character in
B), so each distinct word is encoded and aligned once and kept in a cache of
the worker, which is emptied beyond ``CACHE_WORDS`` words or ``CACHE_TOKENS``
tokens.

1. One pass over the texts encodes them, makes the digests and writes the ids of
   both tokenizers, packed.  Widths of decoded tokens are enough to find the links again.
2. A pass over the ids counts links, and one aggregate adds up every id pair; a
   second one finds the best pairs of every id of B.
3. A last pass over the ids sums the counts of every text.  Pairs that reach a
   threshold count (the lowest that leaves at most ``head_pairs`` of them) are
   broadcast; all others are joined, by text.

Nulls and edge cases: null and empty texts, and texts whose decoded tokens are
not the text (those with a U+2581 of their own), have no tokens, zeros and an
empty digest, and add to no count; a null id stays null; repeated rows count
each; an empty table gives an empty table.  A long text is taken in parts, a
row of ids each, so memory follows the slice and the longest word.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import cuts, pieces
from ledgerline.llm import words as W
from ledgerline.llm.components import staged

SLICE = 2 << 20
CHUNK = 1 << 16
CACHE_WORDS, CACHE_TOKENS = 600_000, 9_000_000
#: Bytes of packed ids taken at once.
RUN = 1 << 19
#: Pairs counted by a task before they are sent on.
FLUSH = 2_000_000

# Bytes after which white space begins a word: neither white space nor control characters, nor bytes that end
# one of the longer white-space characters (U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F,
# U+3000).
SAFE = np.zeros(256, dtype=bool)
SAFE[0x21:0x7F] = True
SAFE[0x80:0xC0] = True
SAFE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
_SPAN = attrgetter("id", "begin", "end")
#: Put before a chunk of words; no piece joins it to white space.
FIRST = b" Q"


def cut(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        out[1:] = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & SAFE[data[:-1]]
    return out


def byte_ends(begins: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The byte after each token, from coarse spans and the decoded width of each token.

    A span counts where it is not empty, the next one begins where it ends and is not empty either; between two
    such places the widths decide.
    """
    if not len(ends):
        return ends
    empty = ends <= begins
    coarse = ~empty
    coarse[:-1] &= (begins[1:] >= ends[:-1]) & ~empty[1:]
    total = np.cumsum(widths)
    last = np.maximum.accumulate(np.where(coarse, np.arange(len(ends)), -1))
    known = last >= 0
    return np.where(known, ends[last] - total[last], 0) + total


def _bytes_of_letters() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable Latin-1 stands for itself, others follow U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids, byte ends and decoded bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        before = made["pre_tokenizer"] or {}
        if made["normalizer"] or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before["add_prefix_space"]:
            raise ValueError("alignment needs a byte-level BPE with its standard pattern and no normaliser")
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        # Offsets that keep the spaces of tokens.
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
        letters, size = _bytes_of_letters(), self.model.get_vocab_size(with_added_tokens=True)
        table = [b""] * size
        for token, i in made["model"]["vocab"].items():
            table[i] = bytes(letters[c] for c in token)
        self.table, self.widths = table, np.array([len(x) for x in table], dtype=np.int64)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        text = data.decode()
        found = self.model.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        spans = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
        if len(text) < len(data):
            at = np.frombuffer(data, dtype=np.uint8)
            at = np.append(np.flatnonzero((at & 0xC0) != 0x80), len(data))
            spans = at[spans]
        return ids, byte_ends(spans[:, 0], spans[:, 1], self.widths[ids])


class Pieces:
    """Ids, byte ends and decoded bytes of a sentencepiece model; the text must begin with the space that it adds."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        info = pieces.read_model(data)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        table = []
        for i in range(self.model.get_piece_size()):
            own = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                table.append(bytes([int(own[3:5], 16)]))
            else:
                if not self.model.is_control(i) and not self.model.is_unknown(i) and "▁" in own.lstrip("▁"):
                    raise ValueError(f"alignment needs pieces with space marks at their beginning only: {own}")
                table.append(own.replace("▁", " ").encode())
        if not pieces.Normalizer(info).simple or not info.add_dummy_prefix or info.space_as_suffix or "\n" in "".join(
            self.model.id_to_piece(i) for i in range(len(table))
        ):
            raise ValueError("alignment needs a piece model with no normalisation but the space mark")
        self.table, self.widths = table, np.array([len(x) for x in table], dtype=np.int64)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        # The proto has spans in bytes (older releases of the library call it immutable_proto).
        found = self.model.encode(data[1:].decode(), return_type="proto", num_threads=1).pieces
        ids, begins, ends = (np.fromiter(x, np.int64, len(found)) for x in zip(*map(_SPAN, found)))
        begins, ends = begins + 1, ends + 1
        begins[0] = 0
        return ids, byte_ends(begins, ends, self.widths[ids])


class Aligner:
    """Both tokenizers and a cache of aligned words; one in each worker.

    ``tokens`` holds, for every cached word, the tokens of both in the order of the digest, as indices into
    ``names``; ``stats`` how many tokens of A, of B, groups and links it has, and where its tokens begin.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        ids = [[str(i) for i in range(len(t))] for t in (self.a.table, self.b.table)]
        names = [i + end for own, ends in zip(ids, (",|", ",;")) for i in own for end in ends]
        self.names = pa.array(names, pa.string())
        self.kinds = [np.dtype("<u2" if len(t) <= 1 << 16 else "<u4") for t in (self.a.table, self.b.table)]
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.tokens = np.zeros(1 << 16, dtype=np.int32)
        self.stats = np.zeros((1 << 12, 5), dtype=np.int64)
        self.ok = np.zeros(1 << 12, dtype=bool)

    def _add(self, words: list[bytes], ok: bool, stats: np.ndarray, tokens: np.ndarray) -> None:
        n, used = len(self.at), int(self.stats[len(self.at), 4])
        while used + len(tokens) > len(self.tokens):
            self.tokens = np.concatenate((self.tokens, np.zeros_like(self.tokens)))
        while n + len(words) >= len(self.ok):
            self.stats = np.concatenate((self.stats, np.zeros_like(self.stats)))
            self.ok = np.concatenate((self.ok, np.zeros_like(self.ok)))
        self.tokens[used : used + len(tokens)] = tokens
        self.stats[n : n + len(words), :4], self.ok[n : n + len(words)] = stats, ok
        # One row more says where the last word ends.
        self.stats[n + 1 : n + len(words) + 1, 4] = used + np.cumsum(stats[:, 0] + stats[:, 1])
        self.at.update(zip(words, range(n, n + len(words))))

    def _encode(self, words: list[bytes]) -> None:
        data = FIRST + b"".join(words)
        a, a_ends = self.a(data)
        b, b_ends = self.b(data)
        if b"".join(map(self.a.table.__getitem__, a)) != data or b"".join(map(self.b.table.__getitem__, b)) != data:
            if len(words) == 1:
                self._add(words, False, np.zeros((1, 4), dtype=np.int64), np.zeros(0, dtype=np.int32))
            else:
                for word in words:
                    self._encode([word])
            return
        # Word i lies between ends[i] and ends[i + 1].
        ends = np.cumsum([len(FIRST), *map(len, words)])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(ends, common).all():
            raise ValueError("a token reaches over the end of a word")
        groups = [np.searchsorted(common, x) for x in (a_ends, b_ends)]
        last = [common[g] == x for g, x in zip(groups, (a_ends, b_ends))]
        codes = np.concatenate((2 * a + last[0], 2 * (len(self.a.table) + b) + last[1]))
        order = np.argsort(np.concatenate((2 * groups[0], 2 * groups[1] + 1)), kind="stable")
        bounds = [np.searchsorted(x, ends, side="right") for x in (a_ends, b_ends, common)]
        n_a, n_b, n_g = (np.diff(x) for x in bounds)
        # A link ends where a token of either ends.
        stats = np.stack((n_a, n_b, n_g, n_a + n_b - n_g), axis=1)
        self._add(words, True, stats, codes[order][bounds[0][0] + bounds[1][0] :])

    def places(self, vocab: pa.Array) -> np.ndarray:
        """The cached place of every word of a vocabulary, after aligning those that are new."""
        own = vocab.to_pylist()
        if len(self.at) + len(own) > CACHE_WORDS or self.stats[len(self.at), 4] > CACHE_TOKENS:
            self.clear()
        held: list[bytes] = []
        size = 0
        for word in [w for w in own if w not in self.at]:
            # A word that ends in white space would run into the next.
            if not SAFE[word[-1]] or len(word) > CHUNK:
                self._encode([word])
                continue
            held.append(word)
            size += len(word)
            if size >= CHUNK:
                self._encode(held)
                held, size = [], 0
        if held:
            self._encode(held)
        return np.fromiter(map(self.at.__getitem__, own), np.int64, len(own))

    def tokens_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the words at ``places``, and how many each word has."""
        sizes = self.stats[places + 1, 4] - self.stats[places, 4]
        return self.tokens[cuts.gathered(self.stats[places, 4], sizes)], sizes


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _texts(batch: pa.RecordBatch, own: Aligner) -> Iterator[tuple]:
    """``(first row, rows, whole, places, bounds, ok)`` of the blocks; the parts of a long text share its ``ok``."""

    def placed(block):
        found = cuts.coded(block, cut)
        return own.places(found.vocab)[found.codes], found.bounds

    held: list = []
    for at, n, whole, block in cuts.blocks(batch["text"], cut, SLICE):
        if not whole or held:
            held.append(block)
            if whole:
                ok = np.array([all(own.ok[placed(x)[0]].all() for x in held)])
                for k, x in enumerate(held):
                    yield at, 1, k == len(held) - 1, *placed(x), ok
                held = []
            continue
        places, bounds = placed(block)
        full = np.diff(np.frombuffer(block.buffers()[1], dtype=np.int32)[block.offset : block.offset + n + 1]) > 1
        yield at, n, True, places, bounds, full & (W.sums((~own.ok[places]).astype(np.int64), bounds) == 0)


ENCODED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a_ids binary, b_ids binary"


def encoded(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``rows(row, doc_id, text)`` with the digest and packed ids in place of the text; a row for each part of a long text.

    The digest of a long text stands in its last row, those before have null.
    """

    def digests(batches):
        own = aligner(path_a, path_b)
        n_a = 2 * len(own.a.table)
        for batch in batches:
            sha = None
            for at, n, whole, places, bounds, ok in _texts(batch, own):
                keep = np.repeat(ok, np.diff(bounds))
                places, doc = places[keep], np.repeat(np.arange(n), np.diff(bounds))[keep]
                cut_at = np.searchsorted(doc, np.arange(n + 1))
                tokens, sizes = own.tokens_of(places)
                text = own.names.take(pa.array(tokens))
                text_ends = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1]
                data = memoryview(text.buffers()[2] or b"")
                ends = np.concatenate(([0], np.cumsum(sizes)))[cut_at]
                spans = list(zip(text_ends[ends], text_ends[ends[1:]]))
                if whole and sha is None:
                    shas = [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in spans]
                else:
                    # Parts of one text; a separator follows each but the last.
                    sha = sha or hashlib.sha256()
                    sha.update(data[: max(0, spans[0][1] - 1)] if whole else data[: spans[0][1]])
                    shas = [None if not whole else sha.hexdigest() if ok[0] else ""]
                    sha = None if whole else sha
                is_a = tokens < n_a
                packed = []
                for mine, base, kind in ((is_a, 0, own.kinds[0]), (~is_a, n_a, own.kinds[1])):
                    ids = ((tokens[mine] - base) >> 1).astype(kind).tobytes()
                    offsets = np.concatenate(([0], np.cumsum(mine)))[ends].astype(np.int32) * kind.itemsize
                    offsets = pa.py_buffer(offsets.astype(np.int32).tobytes())
                    packed.append(pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(ids)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(at, n),
                        batch["doc_id"].slice(at, n),
                        *(pa.array(W.sums(own.stats[places, k], cut_at)) for k in range(4)),
                        pa.array(shas, pa.string()),
                        *packed,
                    ],
                    names,
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {id_type}, {ENCODED}"
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.select("row", "doc_id", "text").mapInArrow(digests, schema)


def _links(batch: pa.RecordBatch, own: Aligner) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, bounds, pairs)``: the pair of each link, by row; both tokenizers cover the same bytes of a row."""
    for at, n, part_a in _runs(batch["a_ids"], RUN):
        part_b = batch["b_ids"].slice(at, n)
        ids, ends = [], []
        for part, table, kind in ((part_a, own.a, own.kinds[0]), (part_b, own.b, own.kinds[1])):
            bounds = np.frombuffer(part.buffers()[1], dtype=np.int32)[part.offset : part.offset + n + 1]
            ids.append(np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]].view(kind).astype(np.int64))
            ends.append(np.cumsum(table.widths[ids[-1]]))
            row_ends = np.concatenate(([0], ends[-1]))[(bounds - bounds[0]) // kind.itemsize]
        # A link ends at every byte where a token of either ends.
        ending = np.zeros((2, int(row_ends[-1]) + 1), dtype=bool)
        ending[0, ends[0]], ending[1, ends[1]] = True, True
        both = np.flatnonzero(ending[0] | ending[1])
        of_a, of_b = (x[np.cumsum(e[both]) - e[both]] if len(x) else x for x, e in zip(ids, ending))
        yield at, n, np.searchsorted(both, row_ends, side="right"), of_a * len(own.b.table) + of_b


def _runs(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, int, pa.Array]]:
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + max_bytes, side="right")) - 1)
        yield at, stop - at, column.slice(at, stop - at)
        at = stop


def pair_counts(found: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(pair, c, best)``: links of every id pair ``a * n_b + b`` of ``encoded`` rows, and whether no other pair of its b has more."""

    def count(batches):
        own = aligner(path_a, path_b)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out():
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys % len(own.b.table)), pa.array(keys), pa.array(counts)], ["b", "pair", "c"]
            )

        for batch in batches:
            for _, _, _, pairs in _links(batch, own):
                found = pa.array(pairs).value_counts()
                held.append((found.field("values").to_numpy(), found.field("counts").to_numpy()))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    counted = found.select("a_ids", "b_ids").mapInArrow(count, "b long, pair long, c long")
    counted = staged(counted.groupBy("b", "pair").agg(F.sum("c").alias("c")), "align-pairs")
    most = counted.groupBy("b").agg(F.max("c").alias("most"))
    return staged(counted.join(most, "b").select("pair", "c", (F.col("c") == F.col("most")).alias("best")), "align-counts")


def align(documents: DataFrame, path_a: str, path_b: str, head_pairs: int = 1 << 20) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for ``documents(doc_id, text)``."""
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    found = staged(encoded(rows, path_a, path_b), "align-ids")
    counted = pair_counts(found, path_a, path_b)
    # At most head_pairs rows.
    head = counted.where(cuts.frequent(counted, "c", head_pairs)).toArrow()
    order = np.argsort(head["pair"].to_numpy())
    values = np.stack((head["best"].to_numpy().astype(np.int64), head["c"].to_numpy()), axis=1)
    shared = spark.sparkContext.broadcast((head["pair"].to_numpy()[order], values[order]))

    def summed(batches):
        own = aligner(path_a, path_b)
        keys, values = shared.value
        for batch in batches:
            for at, n, bounds, pairs in _links(batch, own):
                coded = pa.array(pairs).dictionary_encode()
                unique, back = coded.dictionary.to_numpy(), coded.indices.to_numpy()
                place = np.searchsorted(keys, unique)
                place[place == len(keys)] = 0
                known = keys[place] == unique if len(keys) else np.zeros(len(unique), dtype=bool)
                own_values = np.where(known[:, None], values[place], 0) if len(keys) else np.zeros((len(unique), 2), dtype=np.int64)
                sums = [W.sums(own_values[:, k][back], bounds) for k in range(2)]
                codes, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                if not known.all():
                    rare = ~known[back]
                    rows = np.repeat(np.arange(n), np.diff(bounds))[rare]
                    codes, times = np.unique(rows * len(unique) + back[rare], return_counts=True)
                size = max(1, len(unique))
                split = pa.array(np.searchsorted(codes // size, np.arange(n + 1)).astype(np.int32))
                rare_pairs = unique[codes % size]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(at, n),
                        *map(pa.array, sums),
                        pa.ListArray.from_arrays(split, pa.array(rare_pairs.astype(np.int64))),
                        pa.ListArray.from_arrays(split, pa.array(times.astype(np.int64))),
                    ],
                    ["row", "n_best", "count_sum", "rare", "times"],
                )

    schema = "row long, n_best long, count_sum long, rare array<long>, times array<long>"
    sums = staged(found.select("row", "a_ids", "b_ids").mapInArrow(summed, schema), "align-sums")
    rare = sums.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    tail = rare.select("row", F.col("w.rare").alias("pair"), F.col("w.times").alias("times")).join(counted, "pair").select(
        "row",
        F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
        (F.col("times") * F.col("c")).alias("count_sum"),
    )
    every = found.drop("a_ids", "b_ids").unionByName(sums.drop("rare", "times"), allowMissingColumns=True)
    every = every.unionByName(tail, allowMissingColumns=True)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return every.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        *(F.sum(c).alias(c) for c in numbers),
        F.max("groups_sha256").alias("groups_sha256"),
    ).drop("row")
