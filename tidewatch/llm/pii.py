"""Find personal data: patterns propose, checksums confirm, context adjusts.

A recogniser has a pattern, an optional validator, a score and context words. A
proposed span that fails its validator is dropped, and the search goes on behind
it. A context word within ``CONTEXT_CHARS`` before the span raises its score. Spans
below ``THRESHOLD`` are dropped. The base kinds (email, ip, card, phone) have
scores above it and always stay; an added span that meets one of them goes.

Patterns run in time linear in the text: emails are found from their ``@``, numbers
inside islands of digits, and repeats never give back what they took.

Null and empty texts have no spans. Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import text_udf

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id", "short_card", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS
THRESHOLD = 0.5
CONTEXT_CHARS = 40
CONTEXT_BOOST = 0.4
SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"

_EMAIL_REST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ISLAND = re.compile(r"[0-9][\x20().0-9-]*+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}(?![0-9.-])")
_DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> list[int]:
    return [int(d) for d in _DIGIT.findall(text)]


def luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


def mod_97(text: str) -> bool:
    """The check of ISO 7064 over an account number, country and check digits last."""
    plain = text.replace(" ", "")
    rest = 0
    for c in plain[4:] + plain[:4]:
        value = int(c, 36)
        rest = (rest * (10 if value < 10 else 100) + value) % 97
    return rest == 1


def _octets(text: str) -> bool:
    parts = (p.lstrip("0") for p in text.split("."))
    return all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = digits_of(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_short_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 15 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 8 <= len(_DIGIT.findall(text)) <= 15


def _is_national_id(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Recogniser:
    kind: str
    score: float
    valid: Callable[[str], bool] | None = None
    context: re.Pattern | None = None


def _words(*words: str) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(words) + r")", re.IGNORECASE)


RECOGNISERS = {
    r.kind: r
    for r in (
        Recogniser("email", 0.9, None, _words("mail", "e-mail", "contact", "write")),
        Recogniser("ip", 0.6, _octets, _words("ip", "host", "address", "server")),
        Recogniser("card", 0.9, _is_card, _words("card", "visa", "credit", "karte", "tarjeta", "carte")),
        Recogniser("phone", 0.6, _is_phone, _words("tel", "phone", "call", "fax", "mobil")),
        Recogniser("iban", 0.9, mod_97, _words("iban", "bank", "account", "konto", "cuenta", "compte")),
        Recogniser("national_id", 0.3, _is_national_id, _words("ssn", "social security")),
        Recogniser("short_card", 0.3, _is_short_card, _words("card", "amex", "diners", "credit", "karte", "tarjeta", "carte")),
        Recogniser("local_phone", 0.2, _is_phone, _words("tel", "phone", "call", "fax", "mobil")),
    )
}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in _EMAIL_REST.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    yield from (("email", *span) for span in _emails(text))
    yield from (("phone", *m.span()) for m in _PHONE.finditer(text))
    for island in _ISLAND.finditer(text):
        start, end = island.span()
        if end - start < 7:
            if end - start > 1 and text[start - 2 : start].isupper():
                yield from (("iban", *m.span()) for m in [_IBAN.match(text, start - 2)] if m)
            continue
        yield from (("ip", *m.span()) for m in _IP.finditer(text, start, end))
        for m in _CARD.finditer(text, start, end):
            yield "card", *m.span()
            yield "short_card", *m.span()
        yield from (("national_id", *m.span()) for m in _NATIONAL_ID.finditer(text, start, end))
        opening = start - (text[start - 1 : start] == "(")
        yield from (("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text, opening, end))
        if text[max(0, start - 2) : start].isupper():
            yield from (("iban", *m.span()) for m in [_IBAN.match(text, max(0, start - 2))] if m)


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of each span, by kind as listed, then start."""
    found = []
    for kind, start, end in _proposals(text):
        rule = RECOGNISERS[kind]
        if rule.valid and not rule.valid(text[start:end]):
            continue
        near = rule.context and rule.context.search(text, max(0, start - CONTEXT_CHARS), start)
        score = min(1.0, rule.score + (CONTEXT_BOOST if near else 0.0))
        if score >= THRESHOLD:
            found.append((kind, start, end, round(score, 3)))
    found.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    taken = sorted((s, e) for kind, s, e, _ in found if kind in BASE_KINDS)
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    return [x for x in found if x[0] in BASE_KINDS or not _meets(starts, reach, x[1], x[2])]


def _meets(starts: list[int], reach: list[int], start: int, end: int) -> bool:
    """Whether a base span that begins before ``end`` ends behind ``start``.

    ``reach`` has the largest end of the base spans up to each one, in order of their starts.
    """
    before = bisect_left(starts, end)
    return before > 0 and reach[before - 1] > start


def _spans(texts: pa.Array) -> pa.Array:
    rows = [
        [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in spans_of(t)]
        for t in texts.to_pylist()
    ]
    item = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    )
    return pa.array(rows, pa.list_(item))


def find(text: Column) -> Column:
    """An array of structs kind, start, end, score."""
    return text_udf(_spans, SPAN_TYPE)(text)


def as_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _redact(texts: pa.Array) -> pa.Array:
    return pa.array([redact_text(t) for t in texts.to_pylist()], pa.string())


def redact_text(text: str) -> str:
    """Each stretch covered by spans becomes the name of its first span's kind."""
    spans = sorted((s, -e, k) for k, s, e, _ in spans_of(text))
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, -end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced; a null text stays null."""
    clean = text_udf(_redact, "string")(F.col("text"))
    redacted = docs.withColumn("text", F.when(F.col("text").isNotNull(), clean))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast("long"))
    return redacted
