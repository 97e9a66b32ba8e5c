"""Secret spans against plain loops: every match, and every window counted anew."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import queries, secrets

KEY = "aB3dE5gH7jK9mN1pQ3sT5vX7zZ9"
PATTERNS = {
    "assign": r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def plain(text):
    """(start, rank, end, kind) by loops."""
    base = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            held = m[1] if kind == "assign" else m[0]
            if len(held) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                base.append((m.start(), rank, m.end(), kind))
    added = []
    for rank, kind in enumerate(secrets.CLASSES, 3):
        for m in re.finditer(kind.pattern, text):
            if any(re.search(p, m[0]) for p in secrets.ALLOW):
                continue
            width = kind.width
            hot = [
                i for i in range(len(m[0]) - width + 1) if entropy(m[0][i : i + width]) >= kind.bits - 1e-6
            ]
            if hot:
                span = (m.start() + hot[0], rank, m.start() + hot[-1] + width, kind.kind)
                if not any(s < span[2] and span[0] < e for s, _, e, _ in base):
                    added.append(span)
    return sorted(base + added)


def found(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    rows = df.select("n", secrets.find(F.col("text"), **options).alias("s")).collect()
    return [[(s.start, s.rank, s.end, s.kind) for s in r.s] for r in sorted(rows, key=lambda r: r.n)]


def test_the_base_kinds(spark):
    cases = {
        'token = "abcdefgh"': [(0, 0, 17, "assign")],
        "API_KEY:abcdefgh.": [(0, 0, 17, "assign")],
        "apikey' = abcdefg": [],
        "token=token:abcdefgh": [],  # the first match is too short, and its text is used up
        "secret==abcdefg": [(0, 0, 15, "assign")],
        "AKIA0123456789AB": [(0, 1, 16, "access")],
        "AKIA0123456789A": [],
        "é" + "0a" * 16: [(1, 2, 33, "hex")],
        "0a" * 15 + "0": [],
        "\U0001f600 password: 12345678": [(2, 0, 20, "assign")],
    }
    assert found(spark, list(cases), classes=()) == list(cases.values())


def test_added_spans_and_the_allow_list(spark):
    shown = f"x {KEY} y"
    assert found(spark, [shown]) == [[(2, 4, 2 + len(KEY), "entropy_base64")]]
    suppressed = [
        "123e4567-e89b-12d3-a456-426614174000",
        "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        "src/main/java/com/acme/Widget2Factory",
        "internationalization_of_everything",
        "12345678901234567890123",
        "part-12-of-the-long-report-2",
        "a1G2" * 10,  # little entropy
    ]
    assert found(spark, suppressed) == [[] for _ in suppressed]
    assert found(spark, [shown], allow=(*secrets.ALLOW, "^aB3d")) == [[]]


def test_an_added_span_that_meets_a_base_span_goes(spark):
    texts = [f"token={KEY}", f"{KEY} {'0a' * 16} {KEY}", f"{KEY}{'0a1b2c3d' * 4}"]
    assert found(spark, texts) == [plain(t) for t in texts]
    assert [s[3] for s in found(spark, texts)[1]] == ["entropy_base64", "hex", "entropy_base64"]


def test_random_texts_agree_with_plain_loops(spark):
    draw = random.Random(5)
    parts = ["token", "=", ":", " ", '"', "AKIA", "é", "\n", "secret", KEY, "deadbeef" * 3, "x"]
    letters = "0123456789abcdefABCDEFGHxyzXYZ+/_-="

    def piece():
        if draw.random() < 0.5:
            return draw.choice(parts)
        return "".join(draw.choices(letters[: draw.choice([16, 22, 35])], k=draw.randint(1, 45)))

    texts = ["".join(piece() for _ in range(draw.randint(0, 30))) for _ in range(400)]
    got = found(spark, texts)
    for text, spans in zip(texts, got, strict=True):
        assert spans == plain(text), text


def test_texts_with_very_many_matches(spark):
    """Running sums over blocks: positions stay right, and time stays near linear."""
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(3_000)) + f" {KEY}"
    (spans,) = found(spark, [text])
    assert len(spans) == 3_001
    assert spans == plain(text)


def test_odd_documents_have_defined_results(spark, odd_docs, no_docs):
    rows = odd_docs.withColumn("s", secrets.find(F.col("text"))).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.s == [] for r in rows)
    assert no_docs.select(secrets.find(F.col("text"))).count() == 0


def test_the_query_equals_its_sql_on_planted_texts(spark, tmp_path):
    texts = [None, "", f"key {KEY} token: abcdefghij", "00ff" * 9 + " AKIA" + "Z9" * 8, "plain words"]
    ids = [1, 2, None, 3, 3]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_secret_scan"](spark, str(tmp_path))
    want = duckdb.connect()
    want.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    sql = want.execute(queries.ORACLES["op12_secret_scan"])
    assert got.columns == [c[0] for c in sql.description]
    order = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert order(got.collect()) == order(sql.fetchall())
    assert "entropy_base64" in repr(got.collect())


@pytest.mark.parametrize("name", ["op12_secret_scan"])
def test_nothing_runs_in_python(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
