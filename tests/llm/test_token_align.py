"""Alignment against all pairs of tokens, and against whole texts encoded at once."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import token_align
from tidewatch.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def known():
    with open(token_align.TOKENIZER_A, "rb") as a, open(token_align.TOKENIZER_B, "rb") as b:
        return token_align.Tokenizers(a.read(), b.read())


def spans(ids, tokens):
    ends = np.cumsum([len(tokens[i]) for i in ids]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def plain(texts, known):
    """The contract's rows by loops over whole texts and all pairs of near tokens."""
    rows, links_of = [], []
    for text in texts:
        whole = " " + (text or "")
        a = known.a.encode(whole, add_special_tokens=False).ids if text else []
        b = known.b.encode(text, num_threads=1) if text else []
        joined = {b"".join(known.a_bytes[i] for i in a), b"".join(known.b_bytes[i] for i in b)}
        if not text or joined != {whole.encode()}:
            rows.append([0, 0, 0, 0, ""])
            links_of.append([])
            continue
        sa, sb = spans(a, known.a_bytes), spans(b, known.b_bytes)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        links, low = [], 0
        for i, (s, e) in zip(a, sa):
            while sb[low][1] <= s:
                low += 1
            k = low
            while k < len(sb) and sb[k][0] < e:
                links.append((i, b[k]))
                k += 1
        group_of = {}  # the number of the group that each common end closes
        for number, end in enumerate(common):
            group_of[end] = number
        sides = []
        for ids, where in ((a, sa), (b, sb)):
            side, now = [[] for _ in common], 0
            for i, (_, end) in zip(ids, where):
                side[now].append(str(i))
                now = group_of[end] + 1 if end in group_of else now
            sides.append(side)
        shown = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest()
        rows.append([len(a), len(b), len(common), len(links), digest])
        links_of.append(links)
    count = Counter(link for links in links_of for link in links)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (*row[:4], sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), row[4])
        for row, links in zip(rows, links_of)
    ]


def result(df, **options):
    rows = token_align.compare(df, **options).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return [(r.doc_id, tuple(r[n] for n in names)) for r in rows]


ODD = [
    None,
    "",
    " ",
    "a",
    "Hello world, hello  there\n\n\ttabs",
    "naïve 你好世界 \U0001f600\U0001f468‍\U0001f469 ünïcode",
    "special <|endoftext|> <s> </s> <unk> <0x0A> text",
    "a literal ▁ is not a space",  # B cannot tell them apart
    "nul \0 and \x7f \x85 bytes",
    "x" * 5_000,
    "1234567890" * 300,
    "don't won't it's 's'",
    "\n\n  leading",
    "trailing   ",
]


def test_odd_texts(spark, known):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    want = plain(ODD, known)
    assert dict(result(df)) == dict(enumerate(want))
    assert want[7] == (0, 0, 0, 0, 0, 0, "") and want[6][0] > 0


def test_a_whole_table(spark, known):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").orderBy("doc_id").toPandas()
    found = dict(result(table(spark, SMALL, "documents")))
    assert found == dict(zip(docs.doc_id, plain(docs.text, known)))


def test_blocks_share_the_corpus_counts(spark, known, monkeypatch):
    """Blocks of few documents, on several partitions, and units aligned in small batches."""
    draw = random.Random(3)
    words = ["the", "tokenization", "of", "Größe", "\n", "x=1;", "東京", "naïve", "(see)", " "]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 200))) for _ in range(60)]
    for name, value in (("BATCH", 30), ("BLOCK", 1_000), ("UNITS", 12)):
        monkeypatch.setattr(token_align, name, value)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(token_align)
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        assert dict(result(df)) == dict(enumerate(plain(texts, known)))
    finally:
        cloudpickle.unregister_pickle_by_value(token_align)


def test_texts_are_cut_where_no_token_crosses(known):
    draw = random.Random(9)
    words = ["alpha", "beta's", "12,5", "  ", "\n", "(x)", "Änderung", "日本", "_a_", " ", "--"]
    text = " ".join(draw.choices(words, k=60_000))
    units = known.units(text)
    assert len(units) > 10_000 and " ".join(units) == text
    coded = known.encode(units)
    assert [i for a, _ in coded for i in a] == known.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for _, b in coded for i in b] == known.b.encode(text, num_threads=1)


def test_galloping_finds_ranks():
    draw = np.random.default_rng(1)
    for size, other in ((0, 5), (1, 1), (31, 200), (33, 40), (1_000, 1_200), (700, 90_000)):
        longer = np.cumsum(draw.integers(1, 9, other))
        driver = np.unique(np.append(draw.integers(1, longer[-1] + 1, max(size - 1, 0)), longer[-1]))[:size]
        assert token_align.ranks(driver, longer).tolist() == [bisect_left(longer, x) for x in driver]


def test_groups_hold_all_bytes(spark, known):
    df = spark.createDataFrame([(t,) for t in ODD], "text string")
    rows = df.select("text", token_align.groups(spark, df.text).alias("g")).collect()
    assert [r.g for r in rows[:2]] == [[], []]
    for row in rows[2:]:
        if "▁" in row.text:
            assert row.g == []
            continue
        whole = (" " + row.text).encode()
        for g in row.g:
            for ids, tokens in ((g.a, known.a_bytes), (g.b, known.b_bytes)):
                assert b"".join(tokens[i] for i in ids) == whole[g.start : g.end]
        assert row.g[0].start == 0 and row.g[-1].end == len(whole)


def test_odd_documents_have_defined_results(spark, odd_docs, no_docs, known):
    found = result(odd_docs)
    rows = odd_docs.select("doc_id", "text").collect()
    want = plain([r.text for r in rows], known)
    assert sorted(map(repr, found)) == sorted(repr((r.doc_id, w)) for r, w in zip(rows, want))
    assert result(no_docs) == []
