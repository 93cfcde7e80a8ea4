"""Personal data in texts: patterns propose spans, checksums confirm, context adjusts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm.shared import in_arrow

KINDS = ("email", "ip", "card", "phone", "iban", "national")

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# a run of digits is tried from its first one only: later ones go on in the same way
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# added spans: account numbers (two letters, two check digits, groups), national numbers
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Words that make a span of a kind likelier when they stand near it.
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national": ("ssn", "social", "security", "national", "id"),
}
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national": 0.3}
CONTEXT_BONUS = 0.2
CONTEXT_WINDOW = 40
ADDED_THRESHOLD = 0.5

_NEAR = {kind: re.compile(r"\b(?:" + "|".join(ws) + r")", re.I) for kind, ws in CONTEXT.items()}


def luhn(digits: str) -> bool:
    """The check digit of card numbers: every second digit from the right counts double."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    """The check of account numbers: rearranged and spelt in digits, the remainder is 1."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, ``@`` and dotted domain.

    Searching for the ``@`` first and growing the local part to the left, not beyond the
    last match, finds the same spans in time linear in the text.
    """
    last = 0
    for found in _AT.finditer(text):
        start = found.start()
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        if start < found.start():
            last = found.end()
            yield start, last


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base kinds; matches that fail a check are dropped."""
    spans = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def added_spans(text: str) -> list[tuple[int, int, int]]:
    """Account numbers that pass mod 97, and national numbers with a context word nearby."""
    spans = []
    for m in _IBAN.finditer(text):
        # the pattern may run on into following capitals: the longest prefix that passes
        raw = m[0]
        for end in range(len(raw), 14, -1):
            compact = raw[:end].replace(" ", "")
            if raw[end - 1] != " " and 15 <= len(compact) <= 34 and mod97(compact):
                if end == len(raw) or not raw[end].isalnum():
                    spans.append((m.start(), 4, m.start() + end))
                    break
    for m in _NATIONAL.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            if score(text, m.start(), m.end(), "national") >= ADDED_THRESHOLD:
                spans.append((m.start(), 5, m.end()))
    return spans


def score(text: str, start: int, end: int, kind: str) -> float:
    """The kind's base score, raised where a context word stands within 40 characters."""
    near = text[max(0, start - CONTEXT_WINDOW) : start] + "\n" + text[end : end + CONTEXT_WINDOW]
    return round(min(1.0, BASE_SCORE[kind] + CONTEXT_BONUS * bool(_NEAR[kind].search(near))), 2)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def report(text: str) -> tuple:
    base = base_spans(text)
    every = sorted(base + added_spans(text))
    counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
    scores = [score(text, s, e, KINDS[k]) for s, k, e in every]
    digest = hashlib.sha256(written(base).encode()).hexdigest()
    return (*counts, digest, written(every), ",".join(map(str, scores)))


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string, scores string"
)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, their digest, all spans, scores.

    Spans are kind:start:end in code points, end exclusive, by start, then kind; ``scores``
    has a number from 0 to 1 for each. A missing text counts as empty: no spans and the
    digest of nothing. Ties and repeated rows give equal rows; a missing doc_id stays; an
    empty table gives an empty result; other columns are ignored. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [report(x.as_py() or "") for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64())]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

    return in_arrow(docs.select("doc_id", "text"), run, SCHEMA)
