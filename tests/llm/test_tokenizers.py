"""Token counts and alignment against the libraries and plain Python."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from ledgerline.llm import align, cuts, queries, token_counts
from tests.llm import fixtures

PIECES = public_tokenizers.path(queries.PIECE_MODEL)
BYTES = public_tokenizers.path(queries.BYTE_MODEL)


def rows():
    rng = random.Random(5)
    spaces = [" ", "  ", "\n", "\n\n", "\n ", " \n", "\t", " ", "　 ", " ", "\r\n"]
    odd = ["".join(rng.choice(fixtures.WORDS + ["é", "日本", "😀", "don't", "x.y", "12", "#"]) + rng.choice(spaces) for _ in range(80))
           for _ in range(15)]
    special = ["<s> a </s> <unk> <0x41>", "<|endoftext|> b", "a▁b c", "▁", " lead", "trail ", " ", "\n", "​\x7f\x85"]
    long = " ".join(rng.choice(fixtures.WORDS) for _ in range(30)) + " é\n"
    return fixtures.texts() + [(300 + i, t) for i, t in enumerate(odd + special)] + [(400, long * 21_000), (401, "z" * 50_000)]


def frame(spark, data):
    own = spark.createDataFrame(data, "doc_id long, text string")
    return own.select("*", *(F.lit("x").alias(c) for c in ("row", "n_a", "n_tokens", "pair", "word", "c", "times")))


def grouped(pairs):
    return [(i, list(g)) for i, g in itertools.groupby(pairs, lambda x: x[0])]


def key(r):
    return str(tuple(r))


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("head", [1 << 18, 20])
def test_counts_are_those_of_the_library(spark, model, head):
    want = [(i, len((t or "").encode()), len(model.encode(t or "", num_threads=1))) for i, t in rows()]
    got = token_counts.count_tokens(frame(spark, rows()), PIECES, head_words=head).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_every_pre_token_is_counted_once(spark):
    found = token_counts.pre_tokens(spark.createDataFrame([("a b a b",), ("b",)], "text string"), PIECES).collect()
    assert sorted((bytes(r["word"]), r["c"]) for r in found) == [(b" a", 2), (b" b", 3)]


@pytest.mark.parametrize("cut", [align.cut, token_counts.cutter(PIECES).cut])
@pytest.mark.parametrize("size", [40, 1000, 1 << 20])
def test_parts_of_long_texts_have_the_words_of_the_whole(cut, size):
    column = pa.array([t if t is None else t[:20_000] for _, t in rows()], pa.string())
    split = lambda block: [found.vocab[int(c)].as_py() for found in [cuts.coded(block, cut)] for c in found.codes]
    want = [(i, w) for i in range(len(column)) for w in split(cuts.prefixed(column.slice(i, 1)))]
    got, ends = [], Counter()
    for at, n, whole, block in cuts.blocks(column, cut, size):
        bounds = cuts.coded(block, cut).bounds
        got += list(zip(np.repeat(np.arange(at, at + n), np.diff(bounds)).tolist(), split(block)))
        ends.update({at + k: whole for k in range(n)})
    if cut is not align.cut:
        # A space mark in a slice allows fewer cuts in all of it.
        model = token_counts.cutter(PIECES)
        got, want = ([(i, b"".join(w for _, w in g), sum(model.n_pieces([w for _, w in g]))) for i, g in grouped(x)] for x in (got, want))
    assert got == want and all(ends[i] == 1 for i in range(len(column)))


def brute_align(data, model):
    fast = tokenizers.Tokenizer.from_file(BYTES)
    fast.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(_letters())}
    names = {i: bytes(letters[c] for c in t) for t, i in fast.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}
    piece = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    found, count = [], Counter()
    for i, text in data:
        a = fast.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = model.encode(text, num_threads=1) if text else []
        sizes = [[len(names[x]) for x in a], [len(piece(x)) for x in b]]
        if not text or not b"".join(names[x] for x in a) == b"".join(map(piece, b)) == (" " + text).encode():
            found.append((i, [], [], [], []))
            continue
        ends = [np.cumsum(s).tolist() for s in sizes]
        links = [(a[bisect.bisect_left(ends[0], e)], b[bisect.bisect_left(ends[1], e)]) for e in sorted({*ends[0], *ends[1]})]
        groups, x, y = [], 0, 0
        for e in sorted({*ends[0]} & {*ends[1]}):
            x2, y2 = bisect.bisect_right(ends[0], e), bisect.bisect_right(ends[1], e)
            groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
            x, y = x2, y2
        count.update(links)
        found.append((i, a, b, groups, links))
    best: dict = defaultdict(int)
    for (_, b), c in count.items():
        best[b] = max(best[b], c)
    return [
        (i, len(a), len(b), len(g), len(k), sum(count[x] == best[x[1]] for x in k), sum(count[x] for x in k),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, a, b, g, k in found
    ]


def _letters():
    """The letter of every byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@pytest.mark.parametrize("head", [1 << 20, 40])
def test_alignment_equals_plain_python(spark, model, head):
    data = [(i, t) for i, t in rows() if head > 40 or len(t or "") < 300_000]
    got = align.align(frame(spark, data), BYTES, PIECES, head_pairs=head).collect()
    want = brute_align(data, model)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    zeros = [r for r in want if not r[1]]
    assert {r[0] for r in zeros} >= {110, 111, 123, 317, 318} and all(r[1:] == (0,) * 6 + ("",) for r in zeros)


def test_ends_follow_spans_and_widths_inside_shared_characters():
    # Tokens over bytes 0-2, then three for one character at 2-5, then 5-6.
    begins, ends = np.array([0, 2, 2, 2, 5]), np.array([2, 5, 5, 5, 6])
    assert align.byte_ends(begins, ends, np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]
    begins, ends = np.array([0, 2, 2, 2, 5]), np.array([2, 2, 2, 5, 6])
    assert align.byte_ends(begins, ends, np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]
    begins, ends = np.array([0, 2, 5, 5, 5]), np.array([2, 5, 5, 5, 6])
    assert align.byte_ends(begins, ends, np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert align.align(none, BYTES, PIECES).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        align.ByteLevel(public_tokenizers.path("word_bpe_49k.json"))
