"""Personal data in texts: patterns propose, checks confirm, context scores.

Base kinds (email, ip, card, phone) are leftmost, non-overlapping matches of fixed
patterns, with a check each (parts at most 255, Luhn, number of digits); what fails
is dropped without a retry. The method adds account numbers (IBAN, mod 97), social
security numbers and phone numbers in national form; these need enough score from
their pattern, their check and words nearby.

Every pattern is applied in time linear in the text: a match can only begin at the
start of a run, so no run is scanned twice.

Defined results
* a null text counts as empty; offsets are code points, ends exclusive
* every row gives a row, repeated rows too; a null doc_id stays null
* an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm.common import map_arrow

#: The kinds in their order
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "phone_local")

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{2,4}\) ?|0[0-9]{1,4}[ -])[0-9]{3,4}[ -][0-9]{3,4}(?![0-9])")

#: words that make a span of a kind likelier when they stand nearby
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security"),
    "phone_local": ("phone", "call", "tel", "mobile", "fax"),
}
#: pattern's own score; with a passed check; a context word adds CONTEXT_GAIN
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.5,
         "phone_local": 0.3}
CONTEXT_GAIN = 0.3
#: characters before and after a span in which context words count
CONTEXT_CHARS = 40
#: added spans need this score
THRESHOLD = 0.5
_WORD = re.compile(r"[a-z]+")

SCHEMA = ("doc_id long, kinds array<string>, starts array<int>, ends array<int>, "
          "scores array<double>")


def luhn(digits: str) -> bool:
    doubled = (d * 2 - 9 if d > 4 else d * 2 for d in map(int, digits[-2::-2]))
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _AT.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            last = m.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, in order."""
    found: list[tuple[int, int, int]] = []
    for k, find in enumerate((_emails, _ips, _cards, _phones)):
        found += [(a, k, b) for a, b in find(text)]
    return sorted(found)


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    words = _WORD.findall(near.lower())
    hit = any(w.startswith(c) for w in words for c in CONTEXT[kind])
    return min(1.0, PRIOR[kind] + CONTEXT_GAIN * hit)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = []
    for m in _IBAN.finditer(text):
        compact = m.group().replace(" ", "")
        if 15 <= len(compact) <= 34 and mod97(compact):
            found.append((m.start(), "iban", m.end()))
    for kind, pattern in (("ssn", _SSN), ("phone_local", _PHONE_LOCAL)):
        for m in pattern.finditer(text):
            if kind == "ssn" and (m.group()[:3] in ("000", "666") or m.group()[0] == "9"
                                  or m.group()[4:6] == "00" or m.group()[7:] == "0000"):
                continue
            found.append((m.start(), kind, m.end()))
    if not found:
        return []
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # furthest end so far
    out = []
    for a, kind, b in sorted(found):
        before = bisect_left(starts, b)
        overlaps = kind != "iban" and before and reach[before - 1] > a
        if not overlaps and _score(kind, text, a, b) >= THRESHOLD:
            out.append((a, len(BASE_KINDS) + ADDED_KINDS.index(kind), b))
    return out


def find_spans(text: str) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, score) of one text, by start, then kind."""
    kinds = BASE_KINDS + ADDED_KINDS
    base = base_spans(text)
    spans = sorted(base + added_spans(text, base))
    return [(a, kinds[k], b, _score(kinds[k], text, a, b)) for a, k, b in spans]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [find_spans(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([[s[1] for s in x] for x in spans], pa.list_(pa.string())),
            pa.array([[s[0] for s in x] for x in spans], pa.list_(pa.int32())),
            pa.array([[s[2] for s in x] for x in spans], pa.list_(pa.int32())),
            pa.array([[s[3] for s in x] for x in spans], pa.list_(pa.float64())),
        ], ["doc_id", "kinds", "starts", "ends", "scores"])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and parallel arrays kinds, starts, ends, scores per row of ``docs``.
    Rows are independent: no shuffle."""
    return map_arrow(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]),
                     _batches, SCHEMA)
