import hashlib
import re

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.findall("[0-9]", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


piece = st.sampled_from(
    ["4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "256.1.1.1", "@", "a.b", "x@y.z", "+1 (555) 010-9999", " ",
     "-", ".", "é", "+", "12", "5", "GB82 WEST 1234 5698 7654 32", "(", ")", "\n", "00000000255.0.0.1"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(piece, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.text("019.-+ ()@aZ_%", max_size=60))
def test_base_spans_in_random_text(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a.", "+1", "1 ", "@a.", "(1", "A1"])
def test_long_runs_take_linear_time(unit):
    pii.spans_of(unit * 200_000)


def kinds(text):
    return [s[0] for s in pii.spans_of(text)]


def test_checksums_and_context():
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    assert kinds("pay to GB83 WEST 1234 5698 7654 32 now") == []
    assert kinds("ssn 123-45-6789") == ["national_id"] and kinds("part 123-45-6789") == []
    assert kinds("amex card 378282246310005") == ["short_card"] and kinds("no 378282246310005") == []
    assert kinds("call 555-010-9999") == ["local_phone"] and kinds("sum 555-010-9999") == []
    assert kinds("call +1 (555) 010-9999") == ["phone"]


def test_redaction():
    text = "mail a@b.co or +1 (555) 010-9999, é 1.2.3.4"
    assert pii.redact_text(text) == "mail [EMAIL] or [PHONE], é [IP]"
    assert pii.redact_text("") == ""


def test_query_digest(spark, tmp_path):
    rows = [(1, "é a@b.co 4111111111111111, 1.2.3.4"), (2, None), (2, ""), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op3_pii"](spark, str(tmp_path)).collect()
    want = "email:2:8,ip:27:34,card:9:25"
    (row,) = [r for r in found if r.doc_id == 1]
    assert row.spans == want and row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 0)
    assert {r.spans for r in found if r.doc_id != 1} == {""} and len(found) == 4


def test_odd_rows(odd_docs, no_docs):
    clean = pii.redact(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    assert clean.where(F.col("text").isNull()).count() == 2
    assert pii.redact(no_docs).isEmpty()


def test_very_many_added_and_base_spans_take_linear_time():
    text = "SSN 536-22-1234 mail a.b@c.example " * 12_000
    start = time.perf_counter()
    found = pii.spans_of(text)
    assert len(found) == 24_000 and time.perf_counter() - start < 5


def test_an_added_span_goes_wherever_a_base_span_meets_it():
    import random

    draw = random.Random(2)
    for _ in range(300):
        base = [(s, s + draw.randint(1, 9)) for s in sorted(draw.sample(range(60), draw.randint(0, 8)))]
        starts, reach = [s for s, _ in base], []
        for _, e in base:
            reach.append(max([e, *reach[-1:]]))
        start = draw.randint(0, 60)
        end = start + draw.randint(1, 12)
        assert pii._meets(starts, reach, start, end) == any(s < end and start < e for s, e in base)
