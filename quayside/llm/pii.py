"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds and their proposals (offsets in code points, end exclusive):

* ``email``, ``ip``, ``card``, ``phone``: the base kinds, leftmost and without overlap
  within a kind. An address part over 255, a card without 16 to 19 digits or a
  failing Luhn sum, a phone without 8 to 15 digits drop the match; there are no retries.
* ``iban``: two letters, two digits and 11 to 30 more characters, confirmed by
  mod-97; the longest ending at a gap that passes. The scan goes on behind an accepted
  span, or behind the first four characters where no ending passes.
* ``ssn``: ``ddd-dd-dddd`` with possible numbers.
* ``account``: 13 to 15 digits that pass Luhn.

A span's score starts at ``SCORES``; a word of ``CONTEXT`` within ``REACH`` code
points before or after it adds ``LIFT``. Base spans are always reported; the
others from ``THRESHOLD`` on, and only where no base span lies. Every pattern is
scanned in linear time, whatever the text.

Defined results: null and empty texts have no spans; repeated rows give repeated
rows; extra columns are carried by ``redact`` and not read by ``pii_spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "account")
SCORES = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "account": 0.4}
THRESHOLD, LIFT, REACH = 0.6, 0.3, 40
CONTEXT = {
    "email": ("mail", "contact"), "ip": ("address", "host", "server"),
    "card": ("card", "visa", "credit"), "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social security"),
    "account": ("card", "visa", "amex", "credit"),
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                 ("end", pa.int64()), ("score", pa.float64())]))
Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Whether the sum with every second digit from the right doubled is a multiple of ten."""
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [d * 2 - 9 * (d > 4) for d in values[1::2]]) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while domain and start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, domain.end()
            floor = domain.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def _numbers(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Cards of 16 to 19 digits, and shorter account numbers."""
    cards, accounts = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
            elif 13 <= len(digits) <= 15 and luhn(digits):
                accounts.append(m.span())
    return cards, accounts


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        whole, end, resume = m[0], len(m[0]), m.start() + 4
        while end > 0:
            plain = whole[:end].replace(" ", "")
            if len(plain) < 15:
                break
            if mod97(plain):
                yield m.start(), m.start() + end
                resume = m.start() + end
                break
            end = whole.rfind(" ", 0, end)
        m = _IBAN.search(text, resume)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield m.span()


def find_spans(text: str | None) -> list[Span]:
    """All reported spans by kind, then start."""
    if not text:
        return []
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if _DIGIT.search(text):
        found["ip"] = list(_ips(text))
        found["card"], found["account"] = _numbers(text)
        if "+" in text:
            found["phone"] = list(_phones(text))
        found["iban"] = list(_ibans(text))
        found["ssn"] = list(_ssns(text))
    taken = sorted(span for k in BASE_KINDS for span in found[k])
    out = []
    for kind in KINDS:
        for start, end in found[kind]:
            near = text[max(0, start - REACH):start].lower() + " " + text[end:end + REACH].lower()
            score = SCORES[kind] + LIFT * any(word in near for word in CONTEXT[kind])
            if kind in BASE_KINDS or (
                    score >= THRESHOLD and not any(a < end and start < b for a, b in taken)):
                out.append((kind, start, end, round(min(score, 1.0), 2)))
    return out


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, spans) with spans by kind, then start."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _SPAN_TYPE)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t.as_py())]
                         for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(spans, _SPAN_TYPE)], schema=schema)

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text")).mapInArrow(
        find, f"doc_id bigint, spans {_SPANS}")


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of the given kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str | None) -> str | None:
    """The text with every reported span, or run of overlapping spans, replaced by its kind."""
    if not text or not (spans := sorted((a, -b, k) for k, a, b, _ in find_spans(text))):
        return text
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, -end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text; a count of characters is brought up to date."""
    schema = docs.schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    at = schema.names.index(text_col)
    count_at = schema.names.index(n_chars_col) if n_chars_col in schema.names else None

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [masked(t.as_py()) for t in part.column(at)]
                columns = list(part.columns)
                columns[at] = pa.array(texts, columns[at].type)
                if count_at is not None:
                    columns[count_at] = pa.array([None if t is None else len(t) for t in texts]) \
                        .cast(columns[count_at].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, kinds)
