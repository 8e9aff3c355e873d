"""Secret scans: fixed patterns, and strings that zstandard cannot explain.

Pattern spans (``assign``, ``access``, ``hex``) are the leftmost
non-overlapping matches of the three patterns below; matches that are too
short are dropped after matching, so they still consume their text.

Novelty spans (``novel``): a candidate is a run of key characters that has a
sensitive word before it, on its line or within ``REACH`` characters.  Its
novelty is the number of bytes by which it lengthens the zstandard frame of the
code around it, with a dictionary of identifiers primed into the compressor,
divided by its length.  Derived, repetitive and identifier-like strings cost
little; random key material cannot be shortened and is reported, with or
without digits.  Pattern spans, candidates after sensitive
words (its own copies and all others, which a list of keys consists of) and its later copies
do not count as code around it, and of a reported string every place in the
text is reported; a string that stood in plain text before explains itself.  A
candidate that overlaps a pattern span is not reported twice.

Spans are half-open ranges of code points, for patterns of the whole match.

Nulls and edge cases: a null text is an empty text and has no spans.  Repeated
rows are scanned each on their own, an empty table gives an empty one, and
other columns are not read (``redact_documents`` returns them as they are).  Texts are scanned whole, in time
proportional to their length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W

# The three base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"(?i:passw|passphrase|pwd|secret|token|api_?key|private_?key|access_?key|credential|bearer|authorization|signature)",
    re.ASCII,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

# How far before a candidate its sensitive word may begin on another line, how
# much text around it counts as its surroundings, and from which share of its
# length on a candidate is reported.
REACH, AROUND, NOVELTY = 48, 2048, 0.85

IDENTIFIERS = (
    "abstract", "address", "and", "append", "application", "args", "array", "assert", "async", "await",
    "base64", "boolean", "break", "buffer", "bytes", "callback", "case", "catch", "channel", "char",
    "class", "client", "close", "config", "connection", "const", "constructor", "content", "context", "continue",
    "controller", "count", "create", "database", "date", "debug", "def", "default", "delete", "description",
    "display", "document", "double", "element", "else", "email", "enable", "end", "endpoint", "entry",
    "enum", "environment", "error", "event", "except", "exception", "export", "extends", "extension", "false",
    "field", "file", "filename", "filter", "final", "finally", "float", "for", "format", "function",
    "getElementById", "global", "handler", "hash", "header", "height", "host", "hostname", "http", "https",
    "implements", "import", "include", "index", "init", "input", "insert", "instance", "int", "integer",
    "interface", "isinstance", "item", "iterator", "json", "key", "lambda", "length", "library", "list",
    "listener", "local", "localhost", "logger", "login", "long", "map", "message", "method", "module",
    "namespace", "new", "next", "node", "none", "null", "number", "object", "offset", "open",
    "option", "output", "override", "package", "parameter", "parent", "parse", "password", "path", "pointer",
    "port", "print", "private", "process", "property", "protected", "protocol", "public", "query", "raise",
    "read", "register", "request", "response", "result", "return", "schema", "secret", "select", "self",
    "server", "service", "session", "settings", "size", "source", "start", "state", "static", "status",
    "string", "struct", "super", "switch", "table", "template", "test", "this", "thread", "throw",
    "timeout", "timestamp", "token", "true", "type", "undefined", "update", "user", "username", "value",
    "version", "void", "while", "width", "write", "yield",
)


class Novelty:
    """Marginal compressed bytes under a compressor primed with ``identifiers``."""

    def __init__(self, identifiers: Iterable[str] = IDENTIFIERS, level: int = 3):
        primed = zstandard.ZstdCompressionDict(" ".join(identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(
            level=level, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def share(self, around: str, candidate: str) -> float:
        """Bytes that ``candidate`` adds to ``around``, divided by its length."""
        base = around.encode("utf-8", "surrogatepass")
        alone = len(self._compressor.compress(base))
        return (len(self._compressor.compress(base + candidate.encode())) - alone) / len(candidate)


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return found


class _Taken:
    """Which places overlap any of some spans."""

    def __init__(self, spans: Iterable[tuple[int, int, str]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end, _ in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


class _Without:
    """A text without some merged spans, and where its places went."""

    def __init__(self, text: str, holes: _Taken):
        parts, at, gone = [], 0, 0
        self.holes, self.gone = holes, []
        for start, end in zip(holes.starts, holes.ends):
            parts.append(text[at:start])
            self.gone.append(gone)
            gone, at = gone + end - start, end
        self.text = "".join([*parts, text[at:]])

    def around(self, start: int, own: str) -> str:
        """What surrounds the candidate that begins at ``start`` (inside a hole), without later copies of it."""
        k = bisect_right(self.holes.starts, start) - 1
        at = self.holes.starts[k] - self.gone[k]
        after = self.text[at : at + AROUND + len(own) - 1].replace(own, "")[:AROUND]
        return self.text[max(0, at - AROUND) : at] + "\n" + after + "\n"


def _places(text: str, strings: Iterable[str]) -> Iterator[tuple[int, int]]:
    """Where any of the strings stand in the text, in one pass over it."""
    found = ahocorasick.Automaton()
    for x in strings:
        found.add_word(x, len(x))
    found.make_automaton()
    for last, size in found.iter(text):
        yield last + 1 - size, last + 1


def novel_spans(text: str, taken: list[tuple[int, int, str]], novelty: Novelty, least: float) -> list[tuple[int, int, str]]:
    words = [m.start() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    line, at, held = 0, 0, _Taken(taken)
    asked: list[tuple[int, int, str]] = []
    for m in CANDIDATE.finditer(text):
        line = max(line, text.rfind("\n", at, m.start()) + 1)
        at = m.start()
        k = bisect_left(words, m.start())
        if k and words[k - 1] >= min(line, m.start() - REACH):
            asked.append((m.start(), m.end(), "novel"))
    # Secrets side by side would make each other's letters cheap: none of them is code around another.
    code = _Without(text, _Taken([*taken, *asked]))
    known: set[str] = set()
    for start, end, _ in asked:
        own = text[start:end]
        if own not in known and not held.overlaps(start, end) and novelty.share(code.around(start, own), own) >= least:
            known.add(own)
    if not known:
        return []
    # Copies may also stand inside longer runs; of places that overlap the first and longest counts.
    out: list[tuple[int, int, str]] = []
    for start, end in sorted(_places(text, known), key=lambda x: (x[0], -x[1])):
        if (not out or start >= out[-1][1]) and not held.overlaps(start, end):
            out.append((start, end, "novel"))
    return out


def spans_of(text: str, novelty: Novelty, least: float) -> list[tuple[int, int, str]]:
    found = pattern_spans(text)
    found += novel_spans(text, found, novelty, least)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


SPANS = "array<struct<start: int, end: int, kind: string>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

# A text without any of these has no span of any kind; asked for the whole column at once.
_ANY = r"(?i:passw|passphrase|pwd|secret|token|api_?key|private_?key|access_?key|credential|bearer|authorization|signature)|AKIA|[0-9a-f]{16}"


def find_secrets(text: Column, identifiers: Iterable[str] = IDENTIFIERS, least: float = NOVELTY) -> Column:
    """All spans of a text column by start, then kind."""
    identifiers = tuple(identifiers)
    made: list[Novelty] = []

    @F.arrow_udf(SPANS)
    def scan(column: pa.Array) -> pa.Array:
        if not made:
            made.append(Novelty(identifiers))
        out: list = []
        for part in W.slices(column):
            for some, text in zip(pc.match_substring_regex(part, _ANY).to_pylist(), part):
                out.append(spans_of(text.as_py(), made[0], least) if some else [])
        return pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in out], pa.list_(_SPAN))

    return scan(text)


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span (overlapping ones together) replaced by ``mask``."""

    @F.arrow_udf("string")
    def redact(column: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(column.to_pylist(), found.to_pylist()):
            if text is not None and own:
                parts, at = [], 0
                for x in sorted(own, key=lambda x: x["start"]):
                    if x["start"] >= at:
                        parts += [text[at : x["start"]], mask]
                    at = max(at, x["end"])
                text = "".join(parts) + text[at:]
            out.append(text)
        return pa.array(out, pa.string())

    return redact(text, spans)


def redact_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with secrets replaced in ``text`` and ``n_chars`` (where there is one) counted anew.

    Rows without a secret come back exactly as they are.
    """
    columns = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = rows.withColumn("spans", find_secrets(F.col("row.text")))
    rows = rows.withColumn(
        "text",
        F.when(F.size("spans") > 0, redacted(F.when(F.size("spans") > 0, F.col("row.text")), F.col("spans"))).otherwise(
            F.col("row.text")
        ),
    )
    out = []
    for c in columns:
        own = F.col("row").getField(c)
        if c == "text":
            own = F.col("text")
        elif c == "n_chars":
            kind = documents.schema[c].dataType
            own = F.when(F.size("spans") > 0, F.char_length("text").cast(kind)).otherwise(own)
        out.append(own.alias(c))
    return rows.select(*out)
