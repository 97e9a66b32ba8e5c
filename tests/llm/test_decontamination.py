import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import decontaminate as d


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=70), st.lists(st.integers(0, 6), max_size=90))
def test_common_subsequence(a, b):
    assert d.common_subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == longest(a, b)


def test_answers():
    assert d.answer_of("What is it? Answer: a blue whale.") == "a blue whale."
    assert d.answer_of("One. Two three! Four five").strip() == "Four five"
    assert d.answer_of("") == ""


WORDS = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi") for b in ("ra", "tu", "ni", "so") for c in ("n", "s", "x", "m")]


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "a"]) if rng.random() < 0.4 else rng.choice(WORDS) for _ in range(n))


def test_copies_and_paraphrases_are_found_and_others_left(spark):
    rng = random.Random(8)
    items = [(i, f"question{i} " + " ".join(f"q{i}w{k}" for k in range(rng.choice([12, 40, 150])))
              + f". The answer{i} is value{i} unit{i}.") for i in range(20)]
    docs, want = [], set()
    for i in range(120):
        docs.append((i, prose(rng, rng.choice([20, 200, 900]))))
    for i, text in items:
        words = text.split()
        docs.append((1000 + i, prose(rng, rng.randrange(90)) + " " + text + " " + prose(rng, 70)))
        want.add((1000 + i, i))
        # A paraphrase: every fifth word before the last sentence is another.
        other = [w if k % 5 or k > len(words) - 6 else "instead" for k, w in enumerate(words)]
        docs.append((2000 + i, prose(rng, 50) + " " + " ".join(other) + " " + prose(rng, 50)))
        want.add((2000 + i, i))
        docs.append((3000 + i, prose(rng, 40) + " " + " ".join(words[: len(words) // 3]) + " " + prose(rng, 40)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.find(table, benchmark).collect()}
    assert found == want
    kept = d.drop_leaks(table, benchmark)
    assert kept.columns == table.columns and kept.count() == len(docs) - len(want)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(9)]
    docs = [(i, prose(rng, 60) + " " + t) for i, t in items] + [(99, prose(rng, 200))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_PASSAGES", 4)
    assert {(r.doc_id, r.item_id) for r in d.find(table, benchmark).collect()} == {(i, i) for i in range(9)}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, "alpha beta gamma delta epsilon " * 4), (2, None), (3, ""), (None, "zzz yyy xxx www vvv")]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.find(odd_docs, benchmark).collect()}
    assert found == {(5, 1)}
    assert d.drop_leaks(odd_docs, benchmark).count() == odd_docs.count() - 2
    assert d.drop_leaks(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert d.find(no_docs, benchmark).isEmpty()


def test_items_of_one_word_are_found(spark):
    rng = random.Random(3)
    items = [(1, "zweiundvierzig"), (2, "これは一つの短い問題です。"), (3, "yes yes yes"), (4, " ".join(f"w{k}" for k in range(30)))]
    docs = [(i, prose(rng, 60)) for i in range(40)] + [(100 + i, t) for i, t in items]
    docs += [(201, "Zweiundvierzig!"), (204, "w7"), (205, "w7 w9")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.find(table, benchmark).collect()}
    assert found == {(101, 1), (102, 2), (103, 3), (104, 4), (201, 1)}
