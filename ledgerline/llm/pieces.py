"""SentencePiece encoding that keeps, for every piece, its bytes in the original text.

Encoding has two steps:

1. ``Normalizer`` rewrites a text as the model asks for: at every position the
   longest prefix in the compiled character map (a double-array trie) is
   replaced, other characters stay, spaces are joined, escaped and prefixed as
   the model says.  For each byte of the result the byte of the text it came
   from is recorded.
2. The sentencepiece library segments the normalised text (with its own
   normaliser switched off), and every piece is projected through the recorded
   alignment to ``[begin, end)`` in the bytes of the original text.

A model whose character map is empty needs no trie: the same alignment is then
made for whole texts with numpy.

Ids and spans are returned as little-endian unsigned 32-bit integers in a
binary column, four bytes for each piece; ``unpacked`` turns them into arrays.

Nulls and edge cases: a null text is an empty text, which has the begin and end
ids only.  A decoded null is null.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import words as W

SPACE = "▁".encode()
UNKNOWN, BYTE, USER_DEFINED = 2, 6, 4

# Text encoded at once.
SLICE = 1 << 18


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """``(field number, value, begin, end)`` of a serialized message."""
    at = 0
    while at < len(data):
        begin = at
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value, begin, at


@dataclass
class ModelInfo:
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    space_as_suffix: bool = False
    widths: np.ndarray | None = None
    user_defined: tuple[bytes, ...] = ()
    unknown_id: int = 0
    #: The same model without any normalisation of its own.
    plain: bytes = b""


def read_model(data: bytes) -> ModelInfo:
    info, widths, user, plain = ModelInfo(), [], [], []
    for number, value, begin, end in _fields(data):
        if number == 1:
            piece, kind = b"", 1
            for n, v, _, _ in _fields(value):
                piece, kind = (v, kind) if n == 1 else (piece, v) if n == 3 else (piece, kind)
            if kind == UNKNOWN:
                info.unknown_id = len(widths)
            if kind == USER_DEFINED:
                user.append(piece)
            widths.append(1 if kind == BYTE else len(piece) if kind in (1, USER_DEFINED, 5) else 0)
        elif number == 2:
            info.space_as_suffix = any(n == 24 and v for n, v, _, _ in _fields(value))
        elif number == 3:
            for n, v, _, _ in _fields(value):
                if n == 2:
                    info.charsmap = v
                elif n in (3, 4, 5):
                    setattr(info, ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces")[n - 3], bool(v))
            continue
        plain.append(data[begin:end])
    off = b"".join(bytes([n << 3, 0]) for n in (3, 4, 5))
    info.plain = b"".join(plain) + bytes([3 << 3 | 2, len(off)]) + off
    info.widths, info.user_defined = np.array(widths, dtype=np.int64), tuple(sorted(user, key=len, reverse=True))
    return info


class Normalizer:
    """Longest-prefix normalisation with the origin of every byte."""

    def __init__(self, info: ModelInfo):
        self.info = info
        self.units: list[int] = []
        self.strings = b""
        if info.charsmap:
            size = struct.unpack_from("<I", info.charsmap)[0]
            self.units = np.frombuffer(info.charsmap[4 : 4 + size], dtype="<u4").tolist()
            self.strings = info.charsmap[4 + size :]
        self.simple = not self.units and not info.user_defined and not info.remove_extra_whitespaces

    def _longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that begins at ``at``."""
        units = self.units
        node, best = 0, None
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best = (k + 1 - at, self.strings[start : self.strings.index(0, start)])
        return best

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.info.user_defined:
            if data.startswith(symbol, at):
                return len(symbol), symbol
        if self.units and (found := self._longest(data, at)):
            return found
        lead = data[at]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at : at + size]

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of their positions (the end too) the position in ``data``."""
        return self._whole(data) if self.simple else self._stepwise(data)

    def _whole(self, data: bytes) -> tuple[bytes, np.ndarray]:
        info = self.info
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        origin = np.arange(len(data) + 1)
        mark = SPACE if info.escape_whitespaces else b" "
        if info.escape_whitespaces:
            width = np.ones(len(data) + 1, dtype=np.int64)
            width[:-1][np.frombuffer(data, dtype=np.uint8) == 32] = len(SPACE)
            origin = np.repeat(origin, width)
            data = data.replace(b" ", SPACE)
        if info.add_dummy_prefix:
            if info.space_as_suffix:
                return data + mark, np.concatenate((origin, np.full(len(mark), origin[-1])))
            return mark + data, np.concatenate((np.zeros(len(mark), dtype=np.int64), origin))
        return data, origin

    def _stepwise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        info = self.info
        out, origin, at = bytearray(), [], 0
        mark = SPACE if info.escape_whitespaces else b" "
        if info.remove_extra_whitespaces:
            while at < len(data):
                size, new = self._prefix(data, at)
                if new != b" ":
                    break
                at += size
        if at == len(data):
            return b"", np.full(1, at, dtype=np.int64)

        def space(where: int) -> None:
            out.extend(mark)
            origin.extend([where] * len(mark))

        if info.add_dummy_prefix and not info.space_as_suffix:
            space(at)
        after_space = info.remove_extra_whitespaces
        while at < len(data):
            size, new = self._prefix(data, at)
            while after_space and new.startswith(b" "):
                new = new[1:]
            if new:
                # Where a rule changes the bytes, all of them come from its whole prefix.
                same = new == data[at : at + size]
                for k, byte in enumerate(new):
                    if byte == 32 and info.escape_whitespaces:
                        space(at)
                    else:
                        out.append(byte)
                        origin.append(at + k if same else at)
                after_space = new.endswith(b" ")
            at += size
            after_space = after_space and info.remove_extra_whitespaces
        end = len(data)
        if info.remove_extra_whitespaces:
            while out.endswith(mark):
                end = origin[len(out) - len(mark)]
                del out[len(out) - len(mark) :], origin[len(out) :]
        if info.add_dummy_prefix and info.space_as_suffix:
            space(end)
        return bytes(out), np.array([*origin, end], dtype=np.int64)


class Encoder:
    """Ids and original byte spans of texts; made once in each worker."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.info = read_model(data)
        self.normalize = Normalizer(self.info)
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=self.info.plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=data)

    def _widths(self, ids: np.ndarray, normal: bytes) -> np.ndarray:
        if (ids == self.info.unknown_id).any():
            # An unknown piece covers whatever it stands for.
            return np.array([len(p.encode()) for p in self.plain.encode(normal.decode(), out_type=str, num_threads=1)])
        return self.info.widths[ids]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(ids, begins, ends)`` of each text, with the begin and end ids; those have empty spans."""
        normal = [self.normalize(x) for x in texts]
        found = self.plain.encode([x.decode() for x, _ in normal], num_threads=1)
        first, last = self.whole.bos_id(), self.whole.eos_id()
        out = []
        for text, (norm, origin), own in zip(texts, normal, found):
            own = np.array(own, dtype=np.int64)
            ends = np.cumsum(self._widths(own, norm))
            at = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            out.append(
                (
                    np.concatenate(([first], own, [last])).astype("<u4"),
                    np.concatenate(([0], origin[at], [len(text)])).astype("<u4"),
                    np.concatenate(([0], origin[ends], [len(text)])).astype("<u4"),
                )
            )
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids, num_threads=1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(rows: DataFrame, path: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """``rows`` with ``ids``, ``begins`` and ``ends``, packed, in place of the column ``text``.

    ``decoded`` names a further column for what the library decodes from the
    ids; it is made beside them, so that a task needs no second worker and no
    batch of whole decoded texts.  ``path`` must be readable on every worker.
    Results leave a task slice by slice, so it never holds more than a slice of them.
    """
    kept = [f for f in rows.schema.fields if f.name != text]
    added = [T.StructField(c, T.BinaryType()) for c in ("ids", "begins", "ends")]
    back = [T.StructField(decoded, T.StringType())] if decoded else []
    schema = T.StructType([*kept, *added, *back])

    def pieces(batches):
        for batch in batches:
            at = 0
            for part in W.slices(batch[text], SLICE):
                found = encoder(path).encode(part.cast(pa.binary()).to_pylist())
                packed = [pa.array([x[k].tobytes() for x in found], pa.binary()) for k in range(3)]
                texts = [pa.array(encoder(path).decode([x[0].tolist() for x in found]), pa.string()) for _ in back]
                own = [batch[f.name].slice(at, len(part)) for f in kept]
                yield pa.RecordBatch.from_arrays([*own, *packed, *texts], schema.names)
                at += len(part)

    return rows.mapInArrow(pieces, schema)


def decode(ids: Column, path: str) -> Column:
    """The text of packed ids, as the library decodes them."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        out: list = []
        for x in column:
            own = x.as_py()
            out.append(None if own is None else encoder(path).whole.decode(np.frombuffer(own, dtype="<u4").tolist()))
        return pa.array(out, pa.string())

    return text(ids)


def unpacked(packed: Column) -> Column:
    """A packed column as an array of integers."""

    @F.arrow_udf("array<int>")
    def numbers(column: pa.Array) -> pa.Array:
        own = [None if x is None else np.frombuffer(x, dtype="<u4").astype(np.int32) for x in column.to_pylist()]
        return pa.array(own, pa.list_(pa.int32()))

    return numbers(packed)
