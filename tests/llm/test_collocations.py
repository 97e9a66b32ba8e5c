"""Phrase mining against plain counting of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least=10, longest=3, best=2000, percent=50):
    f, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= least}
    out = []
    for (lang, words), a in candidates.items():
        held = any(
            other == lang
            and len(longer) > len(words)
            and 100 * n >= percent * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), n in candidates.items()
        )
        if held:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, sizes[lang], score))
    ranked = []
    for lang in sizes:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own[:best], 1)]
    return sorted(ranked)


def result(df, **options):
    rows = collocations.mine(df, **options).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def invented(seed, number=150, words=14):
    """Texts of few words, so that many phrases are near the limit; some phrases are planted."""
    draw = random.Random(seed)
    plants = ["New York City", "machine learning", "éa èb ç", "a-b c|d"]
    vocabulary = [f"w{i}" for i in range(words)]
    marks = ["", "", "", ".", ",", "\n", "?!", "\t", "\x0b"]
    rows = []
    for _ in range(number):
        parts = [
            draw.choice(plants) if draw.random() < 0.1 else draw.choice(vocabulary) + draw.choice(marks)
            for _ in range(draw.randint(0, 40))
        ]
        rows.append((draw.choice(["en", "de", None, "und"]), " ".join(parts)))
    return rows


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_plain_counting(spark, longest):
    rows = invented(longest)
    assert result(frame(spark, rows), longest=longest) == plain(rows, longest=longest)


def test_failed_borders_are_closed(spark):
    """With a tiny sample nearly nothing is proposed: all comes from the closure."""
    rows = invented(7)
    failed = []
    found = result(frame(spark, rows), sample_every=1_000, on_failed=failed.append)
    assert found == plain(rows)
    assert len(failed) == 1 and failed[0] > 0
    failed.clear()
    assert result(frame(spark, rows), sample_every=1, on_failed=failed.append) == plain(rows)
    assert failed == [0]  # the sample is the whole, so no border fails


def test_a_full_filter_costs_time_only(spark, monkeypatch):
    rows = invented(9)
    monkeypatch.setattr(collocations.filter_of, "__defaults__", (128,))
    assert result(frame(spark, rows)) == plain(rows)


def test_a_filter_that_takes_an_opened_phrase_for_a_member_loses_none():
    """A phrase was not counted if a part was not, though a filter says that the part was."""
    block = collocations.Block(pa.array(["w b c"]), ["en"])
    missing = block.word_hash[block.word[0]]

    class AllButOneWord:
        def has(self, hashes):
            return hashes != collocations._tagged(missing, 1)

    everything = collocations.Filter(np.full(1, ~np.uint64(0)))
    opened = {k: dict(zip(at.tolist(), new.tolist())) for k, _, at, _, new in block.phrases(3, everything, AllButOneWord())}
    assert opened == {1: {0: False, 1: False, 2: False}, 2: {0: True, 1: False}, 3: {0: True}}


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    rows = invented(11)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 300)
    assert result(frame(spark, rows).repartition(5), rows=6) == plain(rows, best=6)


def test_words_of_odd_texts():
    texts = ["", "A b", "É É. x", " \t ", ".,;", "a\x00b c\x0bd", "x" * 9, "a b"]
    words, text, left = collocations.words_of(pa.array(texts))
    want = [(i, w, len(p) - k) for i, t in enumerate(texts) for p in pieces_of(t) for k, w in enumerate(p)]
    assert list(zip(text.tolist(), words.to_pylist(), left.tolist())) == want
    sliced = collocations.words_of(pa.array(["zz zz", *texts]).slice(1))
    assert sliced[0].equals(words) and np.array_equal(sliced[2], left)


def test_large_counts_stay_exact(spark):
    """Products beyond 64 bits: a a 10^6 is near 10^33 here."""
    a, left, right = 31_622_776_601_683, 99_999_999_999_999, 31_622_776_601_684
    rows = [("en", 1, "p", left), ("en", 1, "q", right), ("en", 2, "p q", a)]
    found = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    (row,) = collocations.scored(found).collect()
    assert row.score == 1_000_000 * a * a // (left * right)


def test_phrases_that_are_no_part_of_others_are_not_spread(spark, monkeypatch):
    words = [f"w{i}" for i in range(6)]
    pairs = [(w, v) for w in words for v in words]
    rows = [("en", 1, w, 100) for w in words] + [("en", 2, f"{w} {v}", 20) for w, v in pairs]
    rows += [("en", 3, "w0 w1 w2", 12), ("de", 1, "w0", 50)]
    found = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    known = []
    with_counts = collocations._with_counts
    monkeypatch.setattr(
        collocations, "_with_counts", lambda rows, part, some, name: known.append(some) or with_counts(rows, part, some, name)
    )
    scores = {r.phrase: (r.l, r.r, r.score) for r in collocations.scored(found).collect()}
    assert scores == {f"{w} {v}": (100, 100, 40_000) for w, v in pairs} | {"w0 w1 w2": (100, 20, 72_000)}
    for some in known:
        assert {(r.lang, r.phrase) for r in some.collect()} == {("en", p) for p in [*words, "w0 w1", "w1 w2"]}


def test_ties_go_to_the_first_cut_and_the_smaller_phrase(spark):
    rows = [("en", "b c. b c. a b. a b. x y z. x y z.")] * 5
    assert result(frame(spark, rows)) == plain(rows)


def test_odd_documents_have_defined_results(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    assert result(odd_docs) == plain(rows)
    assert result(no_docs) == []
