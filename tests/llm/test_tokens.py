import numpy as np
import pytest

from tidewatch.llm import token_counts as t


@pytest.fixture(scope="module")
def encoder():
    with open(t.VOCABULARY, "rb") as file:
        return t.Encoder(file.read())


def brute(text, lengths, encoder):
    """Owner of each token by looking at each character."""
    owner_of = [i for i, n in enumerate(lengths) for _ in range(n)]
    byte_char = [c for c, ch in enumerate(text) for _ in ch.encode()]
    counts, crossing, at = [0] * len(lengths), [0] * len(lengths), 0
    for token in encoder.encoding.encode_ordinary(text):
        width = len(encoder.encoding.decode_single_token_bytes(token))
        chars = sorted({byte_char[b] for b in range(at, at + width)})
        owners = [owner_of[c] for c in chars]
        best = max(sorted(set(owners)), key=lambda o: (owners.count(o), -o))
        counts[best] += 1
        crossing[best] += len(set(owners)) > 1
        at += width
    return counts, crossing


@pytest.mark.parametrize("text", ["hello world\n\n\nnext  line\n", "éé ñandú 😀\nß 中文字 x", "a", " \n \n", "abc" * 50])
@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_tokens_go_where_most_of_them_lies(encoder, text, cut):
    lengths = [len(text[i : i + cut]) for i in range(0, len(text), cut)]
    total, tokens, crossing = t.attribute_text(text, np.array(lengths), encoder)
    assert (tokens.tolist(), crossing.tolist()) == brute(text, lengths, encoder)
    assert tokens.sum() == total == len(encoder.encoding.encode_ordinary(text))


def test_lines_add_up(spark, odd_docs, no_docs, encoder):
    rows = t.by_line(odd_docs).collect()
    for r in odd_docs.where("doc_id in (2, 3, 6, 7)").collect():
        mine = [x for x in rows if x.doc_id == r.doc_id]
        assert sum(x.n_tokens for x in mine) == len(encoder.encoding.encode_ordinary(r.text))
        assert {x.doc_tokens for x in mine} == {sum(x.n_tokens for x in mine)}
        assert [x.n_chars for x in sorted(mine, key=lambda x: x.section)] == [len(s) for s in r.text.split("\n")]
    assert [(x.section, x.n_tokens) for x in rows if x.doc_id == 1] == [(1, 0)]
    assert t.by_line(no_docs).isEmpty()


def test_fields(spark, encoder):
    df = spark.createDataFrame([("a title", "the body of it", 3), (None, "", 4)], "title string, body string, n int")
    rows = t.by_field(df, ["title", "body"]).orderBy("n").collect()
    whole = len(encoder.encoding.encode_ordinary("a title\nthe body of it"))
    assert sum(rows[0].field_tokens.values()) == whole and set(rows[0].field_tokens) == {"title", "body"}
    assert sum(rows[1].field_tokens.values()) == len(encoder.encoding.encode_ordinary("\n"))
