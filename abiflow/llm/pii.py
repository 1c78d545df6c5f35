"""Personal data, disguised or not, by offset-preserving deobfuscation.

Plain identifiers are found in the text itself (the base spans).  Then small
transducers rewrite the text into a plainer one and keep for every character
of it the source characters it stands for: look-alike letters and digits
become ASCII, zero-width characters vanish, ``(at)``, ``[dot]`` and `` at ..
dot `` become ``@`` and ``.``, and runs of spelled digits become digits.
The same detectors run over the rewritten text and their spans are carried
back to source characters.  A span found that way is added unless a base
span of its kind covers it; base spans always stay.

Null and empty texts have no spans.  Repeated rows: each gets its spans.
Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool = True


# --- plain identifiers -----------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so a run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with what is before and after it; the pattern's local part
    has no ``@``, so every match has its own."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Plain identifiers: for each kind leftmost, non-overlapping matches;
    matches that fail their test are dropped and not tried again."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found["phone"].append(m.span())
    return found


# --- transducers -----------------------------------------------------------

# Look-alikes of ASCII letters (Cyrillic, Greek), fixed values.
_LOOKS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n", "ɡ": "g", "ӏ": "l", "ⅼ": "l", "ı": "i",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
_ZERO_WIDTH = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
# Full-width forms and the digits of other scripts, by rule.
_LOOKS |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}
_LOOKS |= {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
_LOOK = re.compile("[" + re.escape("".join(_LOOKS)) + _ZERO_WIDTH + "]")

# Spelled digits (fixed values).
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_DIGIT_WORD = "(?:" + "|".join(_SPELLED) + ")"
_GAP = r"[\x20\t\n,()\[\]-]{1,4}"
#: Tokens that stand for so many digits, or so many tokens with dots among
#: them, one of them spelled, make a run of spelled digits.
LEAST_RUN = 7
_RUN_TOKEN = rf"(?:{_DIGIT_WORD}|[0-9]++|dot|point)(?![A-Za-z0-9])"
_RUN = re.compile(rf"(?<![A-Za-z0-9])(?:plus{_GAP}|\+[\x20(]{{0,2}})?(?:{_DIGIT_WORD}|[0-9]++)(?![A-Za-z0-9])(?:{_GAP}{_RUN_TOKEN})++", re.I)
_RUN_PART = re.compile(rf"(?P<plus>plus|\+)|(?P<word>{_DIGIT_WORD})|(?P<digits>[0-9]+)|(?P<dot>dot|point)", re.I)
_HAS_WORD = re.compile(rf"(?<![A-Za-z])(?:{_DIGIT_WORD}|plus)(?![A-Za-z])", re.I)

_AT = r"(?:\x20?[\[({<]\x20?(?:at|@)\x20?[\])}>]\x20?|\x20at\x20|\x20?@\x20?)"
_DOT = r"(?:\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20|\.)"
# A whole disguised address: local part (of up to nine labels), at, at least two labels.  A bare
# `` at `` counts only before a disguised dot, so that prose stays prose.
_ADDRESS = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:{_DOT}[A-Za-z0-9_%+-]++){{0,8}}?(?P<at>{_AT})[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.I
)
_MARK = re.compile(rf"(?P<at>{_AT})|(?P<dot>{_DOT})", re.I)
_DOTTED_IP = re.compile(rf"(?<![A-Za-z0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![A-Za-z0-9])", re.I)
# What a text must hold for any of the rewritings above to apply.
_TRIGGER = re.compile(rf"[\[({{<]\x20?(?:at|dot|@|\.)\x20?[\])}}>]|\x20dot\x20|\x20@|@\x20|{_DIGIT_WORD}{_GAP}{_RUN_TOKEN}|[0-9]{_GAP}{_DIGIT_WORD}(?![A-Za-z])|plus{_GAP}[0-9]", re.I)


class Rewritten:
    """A text and, for each of its characters, the source span it covers."""

    def __init__(self, text: str, spans: list[tuple[int, int]] | None = None) -> None:
        self.text = text
        self.spans = spans  # None: each character is itself

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.spans is None:
            return start, end
        return self.spans[start][0], self.spans[end - 1][1]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """Ordered, non-overlapping (start, end, new text) edits applied.
        Each new character covers what its edit replaced."""
        if not edits:
            return self
        spans = self.spans if self.spans is not None else [(k, k + 1) for k in range(len(self.text))]
        out: list[str] = []
        new: list[tuple[int, int]] = []
        done = 0
        for start, end, put in edits:
            out += (self.text[done:start], put)
            new += spans[done:start]
            new += [(spans[start][0], spans[end - 1][1])] * len(put)
            done = end
        out.append(self.text[done:])
        return Rewritten("".join(out), new + spans[done:])


def _looks(r: Rewritten) -> Rewritten:
    return r.rewrite([(m.start(), m.end(), _LOOKS.get(m[0], "")) for m in _LOOK.finditer(r.text)])


def _spelled(r: Rewritten) -> Rewritten:
    edits = []
    for run in _RUN.finditer(r.text):
        if not _HAS_WORD.search(run[0]):
            continue
        parts = list(_RUN_PART.finditer(r.text, *run.span()))
        n_digits = sum(len(m["digits"]) if m["digits"] else m["word"] is not None for m in parts)
        if max(n_digits, sum(m["plus"] is None for m in parts)) < LEAST_RUN:
            continue
        done = run.start()
        for m in parts:
            if m.start() > done:  # the gap before it goes
                edits.append((done, m.start(), ""))
            put = "+" if m["plus"] else "." if m["dot"] else m["digits"] or _SPELLED[m[0].lower()]
            if put != m[0]:
                edits.append((*m.span(), put))
            done = m.end()
    return r.rewrite(edits)


def _marks(r: Rewritten) -> Rewritten:
    edits = []
    taken = 0
    whole = [m for m in _ADDRESS.finditer(r.text) if m["at"].strip() != "at" or re.search(r"dot|[\[({<]", r.text[m.end("at") : m.end()], re.I)]
    whole += _DOTTED_IP.finditer(r.text)
    for m in sorted(whole, key=lambda m: m.span()):
        if m.start() < taken:
            continue
        taken = m.end()
        edits += [(*x.span(), put) for x in _MARK.finditer(r.text, *m.span()) if x[0] != (put := "@" if x["at"] else ".")]
    return r.rewrite(edits)


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed, then start, then end."""
    if not text:
        return []
    base = detect(text)
    spans = [Span(k, s, e) for k in KINDS for s, e in base[k]]
    looks = not text.isascii() and _LOOK.search(text) is not None
    if looks or _TRIGGER.search(text):
        r = _looks(Rewritten(text)) if looks else Rewritten(text)
        r = _marks(_spelled(r))
        if r.spans is not None:
            for kind, found in detect(r.text).items():
                covered = base[kind]
                begins = [s for s, _ in covered]
                for s, e in (r.source(*x) for x in found):
                    k = bisect.bisect_right(begins, s) - 1
                    if k < 0 or covered[k][1] < e:
                        spans.append(Span(kind, s, e, False))
    return sorted(set(spans), key=lambda x: (KINDS.index(x.kind), x.start, x.end))


def redact_text(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; spans that
    overlap become one, named by the first."""
    if not text:
        return text
    out, done = [], 0
    for s in sorted(find_spans(text), key=lambda x: (x.start, -x.end)):
        if s.start < done:
            done = max(done, s.end)
            continue
        out += (text[done : s.start], f"[{s.kind.upper()}]")
        done = s.end
    return "".join([*out, text[done:]])


# --- on tables -------------------------------------------------------------

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def with_spans(docs: DataFrame, column: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, base) of each text."""
    find = pandas_udf(lambda texts: texts.map(lambda t: [x._asdict() for x in find_spans(t)]), SPAN_TYPE)
    return docs.withColumn(column, find(F.col("text")))


#: Texts that are redacted at a time.
REDACT_ROWS = 256


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every identifier in ``text`` replaced by its kind.  The
    rows pass as Arrow, some at a time, and a worker gives back what Arrow
    holds of them: no frame library is loaded, no batch is held twice."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, REDACT_ROWS):
                part = b.slice(lo, REDACT_ROWS)
                text = pa.array([redact_text(t) for t in part.column(at).to_pylist()], part.schema.field(at).type)
                yield part.set_column(at, part.schema.field(at), text)
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def span_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the digest of the base spans
    and all spans as text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(lo, 1024) for x in batches for lo in range(0, x.num_rows, 1024)):
            rows = []
            for t in b.column(1).to_pylist():
                spans = find_spans(t)
                base = [s for s in spans if s.base]
                sha = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(sum(s.kind == k for s in base) for k in KINDS), sha, _joined(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [b.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])]
            yield pa.record_batch(arrays, names=["doc_id", *counts, "base_sha256", "spans"])

    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in counts) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(digest, schema)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)
