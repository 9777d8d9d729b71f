"""Operator 4: secret scans.

Base patterns find labelled assignments, access keys and long hex strings.  The
method adds entropy spans: a candidate is a run of key characters; a window of
``WINDOW`` characters slides over it, its Shannon entropy kept up to date from
the counts of the one character that enters and the one that leaves; windows at or
above the threshold of the candidate's character class are merged into a span.
Candidates on the allow-list and spans inside a base span add nothing.

Defined cases: a null text counts as empty; spans are in code points, end
exclusive; repeated rows give repeated results; other columns pass through
``redact`` and are ignored by ``scan``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._stage import table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits a character at or above which a window counts, by the alphabet that the candidate shows.
#: Each is under the 0.5 % quantile of windows of uniform random keys over the smallest alphabet in
#: use for it: 16 characters, 32 (base32 in either case), 58 (base58), 52 (letters of both cases).
THRESHOLDS = {"hex": 2.82, "lower": 3.28, "upper": 3.28, "mixed": 3.58, "letters": 3.52}
#: Words in camel case; a word may be an acronym where all others have four letters or more or are common.
CAMEL = (r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*"
         r"|(?:[A-Z]?[a-z]{3,}|get|set|[A-Z]{2,5}(?=[A-Z][a-z]{3}))(?:[A-Z][a-z]{3,}|(?:And|As|At|By|For|In|Is|Not|Of|On|Or|To)(?![a-z])"
         r"|[A-Z]{2,4}(?=[A-Z][a-z]{3}|[^A-Za-z]|$))*)[0-9]{0,4}")
#: A word of one case, a short one with a number (``python3``), a short name, camel case, a number, an
#: ordinal or unit.  Atomic, as one text may be several of these.
PIECE = (r"(?>(?:[a-z]+|[A-Z]+|(?:[a-z]{1,14}|[A-Z]{1,15})[0-9]{1,4}|[A-Za-z]{1,3}|[A-Z]{2,5}s|" + CAMEL +
         r"|[0-9]{1,4}(?:st|nd|rd|th|[dhkmpsx]|px|[kmg]b|[ap]m)?)(?![A-Za-z0-9]))")
#: Candidates that are no secrets: pieces with or without joints (prose, paths, slugs,
#: constants); UUIDs; and numbers.
ALLOWED = re.compile(
    rf"[-_/=+]*{PIECE}(?:[-_/=+]+{PIECE})*[-_/=+]*"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[-+_/=0-9]+")
#: A digest that its own label declares (a checksum, not a secret).
DECLARED = re.compile(r"(?:sha(?:1|224|256|384|512)|md5|integrity|checksum|commit)[\"']?[\x20:=-]{1,3}[\"']?$", re.IGNORECASE)
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_XLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def character_class(candidate: str) -> str:
    """``hex``, ``letters`` without a digit, or letters of ``lower``, ``upper`` or ``mixed``
    case with digits, whatever the joints."""
    seen = set(candidate) - set("+/_=-")
    if seen <= _HEX_DIGITS:
        return "hex"
    if not any(c.isdigit() for c in seen):
        return "letters"
    return "lower" if not any(c.isupper() for c in seen) else "upper" if not any(c.islower() for c in seen) else "mixed"


def entropy_spans(candidate: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows whose entropy reaches the threshold."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    limit = (math.log2(window) - threshold) * window + 1e-9  # H = log2(w) - sum(c log2 c) / w
    for i, entering in enumerate(candidate):
        if i >= window:
            leaving = candidate[i - window]
            c = counts[leaving]
            counts[leaving] = c - 1
            total += _XLOG[c - 1] - _XLOG[c]
        c = counts.get(entering, 0)
        counts[entering] = c + 1
        total += _XLOG[c + 1] - _XLOG[c]
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    low, found = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Entropy spans that no base span holds."""
    found = []
    starts, furthest = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    for m in CANDIDATE.finditer(text):
        candidate = m.group()
        if ALLOWED.fullmatch(candidate) or DECLARED.search(text[max(0, m.start() - 24):m.start()]):
            continue
        for a, b in entropy_spans(candidate, THRESHOLDS[character_class(candidate)]):
            a, b = a + m.start(), b + m.start()
            at = bisect_right(starts, a)
            if not at or furthest[at - 1] < b:
                found.append((a, 3, b))
    return found


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the count of each base kind, base_sha256 and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                text = batch.column(1)[k].as_py() or ""
                base = base_spans(text)
                kinds = [s[1] for s in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(told(base).encode()).hexdigest(),
                             told(sorted(base + added_spans(text, base)))))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                names=[id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, mask: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones together) replaced by the mask."""
    base = base_spans(text)
    out, done = [], 0
    spans = sorted(base + added_spans(text, base))
    k = 0
    while k < len(spans):
        a, _, b = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < b:
            b = max(b, spans[k][2])
            k += 1
        out += [text[done:a], mask]
        done = b
    return "".join(out) + text[done:]


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, secrets masked; a null text stays null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t) for t in (v.as_py() for v in batch.column(names.index(text_col)))]
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array(texts, batch.schema.field(text_col).type)
            if chars_col in names:
                old = batch.column(names.index(chars_col))
                columns[names.index(chars_col)] = pa.array(
                    [o.as_py() if t is None else len(t) for o, t in zip(old, texts, strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLES: dict[str, str] = {}
