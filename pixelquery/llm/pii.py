"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pixelquery.llm.text import whole

#: Spans with equal starts are listed in this order.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "tel")
SPANS = "ARRAY<STRUCT<kind: STRING, start: INT, end: INT, score: DOUBLE, base: BOOLEAN>>"
_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
               ("base", pa.bool_())])
)

# Patterns.  A start inside a run of digits cannot match where the start of the run did not, so the
# look-behinds and possessive repeats leave the matches as they are and keep the search linear.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+(])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,4}(?![0-9])")
WORD = re.compile(r"[^\W\d_]+")
NOT_DIGIT = re.compile(r"[^0-9]")

# Lengths of account numbers of some countries; others need the checksum only.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27,
    "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}
#: Score of a confirmed pattern without any word nearby.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "tel": 0.35}
#: Words nearby that speak for a kind, in the languages of the tables.
FOR = {
    "email": {"mail", "email", "contact", "kontakt", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "tel": {"phone", "tel", "telephone", "mobile", "fax", "telefon", "handy", "téléphone", "teléfono", "móvil"},
}
#: Words nearby that speak against any kind.
AGAINST = {"isbn", "issn", "version", "invoice", "order", "serial", "rechnung", "facture", "factura"}
NEAR, UP, DOWN = 40, 0.35, 0.35


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether letters as numbers, with country and check digits last, leave 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the letters before it that no earlier match or ``@`` has, and a domain after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        n = LOCAL.match(text[last:at][::-1]).end() if domain else 0
        if n:
            yield at - n, domain.end()
        last = domain.end() if n else at + 1
        at = text.find("@", last)


def _matches(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def _is_ip(found: str) -> bool:
    return all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))


def _is_card(found: str) -> bool:
    digits = NOT_DIGIT.sub("", found)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: str) -> bool:
    return 10 <= len(NOT_DIGIT.sub("", found)) <= 15


def _is_iban(found: str) -> bool:
    account = found.replace(" ", "")
    return 15 <= len(account) <= 34 and len(account) == IBAN_LENGTH.get(account[:2], len(account)) and mod97(account)


def _is_ssn(found: str) -> bool:
    area, group, serial = found.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _is_tel(found: str) -> bool:
    return 8 <= len(NOT_DIGIT.sub("", found)) <= 13


#: Kind, proposed spans, test of a proposal.  The first four are the base, the others are added by the method.
BASE = (("email", _emails, None), ("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone))
ADDED = (("iban", IBAN, _is_iban), ("ssn", SSN, _is_ssn), ("tel", TEL, _is_tel))


def confirmed(text: str, proposed, test) -> Iterator[tuple[int, int]]:
    spans = _matches(proposed, text) if isinstance(proposed, re.Pattern) else proposed(text)
    return ((a, b) for a, b in spans if test is None or test(text[a:b]))


def score(kind: str, text: str, start: int, end: int) -> float:
    """The kind's prior, raised by a word for it and lowered by a word against it within ``NEAR`` characters."""
    near = {w.lower() for w in WORD.findall(text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR])}
    moved = PRIOR[kind] + UP * bool(near & FOR[kind]) - DOWN * bool(near & AGAINST)
    return round(min(1.0, max(0.0, moved)), 6)


def find(text: str, least: float = 0.6) -> list[Span]:
    """Spans of a text by start, then in the order of ``KINDS``; ends are exclusive.

    Base spans stay whatever their score.  Others need ``least`` and must not touch a base span or a
    span added before.
    """
    spans = [
        Span(kind, a, b, score(kind, text, a, b), True)
        for kind, proposed, test in BASE
        for a, b in confirmed(text, proposed, test)
    ]
    taken: list[tuple[int, int]] = []  # disjoint, by place
    for a, b in sorted((s.start, s.end) for s in spans):
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(b, taken[-1][1])
        else:
            taken.append((a, b))
    for kind, proposed, test in ADDED:
        for a, b in confirmed(text, proposed, test):
            before = bisect_left(taken, (b,))
            free = before == 0 or taken[before - 1][1] <= a
            if free and (value := score(kind, text, a, b)) >= least:
                taken.insert(before, (a, b))
                spans.append(Span(kind, a, b, value, False))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def with_spans(docs: DataFrame, text: str = "text", least: float = 0.6, spans: str = "spans") -> DataFrame:
    """``docs`` with an array ``spans`` of ``kind, start, end, score, base`` (replacing a column of that name).

    Places count code points of the whole text.  A null or empty text has no spans.  Repeated rows are
    judged each by itself, other columns of any name and type go through untouched, and an empty table
    gives no rows.  Texts are read one at a time inside the tasks that scan them; nothing is shuffled.
    """
    kept = [c for c in docs.columns if c.lower() != spans.lower()]
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]  # names with dots go by number
    source = docs.select(*columns, whole(f"`{text}`").alias("body"))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in find(value.as_py(), least)] for value in batch.column(len(kept))]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _SPAN)], [*kept, spans])

    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    schema = StructType([*schema, StructField(spans, StructType.fromDDL(f"spans {SPANS}")["spans"].dataType)])
    return source.mapInArrow(rows, schema)


def masked(docs: DataFrame, text: str = "text", least: float = 0.6) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; nulls stay null.

    Where spans overlap, the one that starts first covers the rest.
    """
    at, kept = docs.columns.index(text), docs.columns

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(at):
                body = value.as_py()
                parts, done = [], 0
                for span in find(body or "", least):
                    if span.start >= done:
                        parts += [body[done : span.start], f"<{span.kind}>"]
                    done = max(done, span.end)
                out.append(None if body is None else "".join([*parts, body[done:]]))
            columns = [batch.column(i) for i in range(len(kept))]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, kept)

    return docs.toDF(*[f"c{i}" for i in range(len(kept))]).mapInArrow(rows, docs.schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
