import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import words
from tidewatch.llm.common import chunks

texts = st.lists(st.text("aB1 é.ß\n,", max_size=40), max_size=8)


def plain(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_those_of_a_pattern(given_texts):
    found = words.words_of(pa.array(given_texts, pa.string()))
    want = [w for t in given_texts for w in plain(t)]
    assert found.counts.tolist() == [len(plain(t)) for t in given_texts]
    raw = found.data.tobytes()
    assert [raw[s:e].decode() for s, e in zip(found.starts, found.ends, strict=True)] == want
    ids = {}
    assert all(ids.setdefault(w, h) == h for w, h in zip(want, found.hashes.tolist(), strict=True))
    assert len(set(ids.values())) == len(ids)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_shingles_are_sets_of_words_in_a_row(given_texts):
    column = pa.array(given_texts, pa.string())
    values, number = words.distinct_per_text(*words.shingles_of(words.words_of(column), 3))
    sets, at = [], 0
    for n in number:
        sets.append(frozenset(values[at : at + n].tolist()))
        at += n
    want = []
    for text in given_texts:
        w = plain(text)
        runs = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
        want.append(frozenset(runs))
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(sets)):
        for j in range(i):
            assert len(sets[i] & sets[j]) == len(want[i] & want[j])


def test_slices_cover_a_column_once():
    column = pa.array(["aa", "", "b" * 50, "c", "dd"]).slice(1)
    parts = list(chunks(column, 4))
    assert [x for p in parts for x in p.to_pylist()] == ["", "b" * 50, "c", "dd"]
    assert len(parts) > 1 and list(chunks(column.slice(0, 0))) == []
    assert words.words_of(column.slice(0, 0)).hashes.dtype == np.uint64
