"""The two classifiers: gradients, held-out accuracy, and odd texts."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewatch.llm import bigru, langid, queries, toxicity, words
from tidewatch.llm.sample import labelled_sample

DATA = "/root/testdata/sf0.1"


def test_gradients_are_those_of_differences():
    found = words.words_of(pa.array(["one two three four", "five six one"]))
    _, at, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
    lexicon = toxicity.lexicon_of(found, at)
    index = np.array([[0, 1, 2, 3], [4, 5, 6, 6]])
    index, mask = inverse[index], np.array([[1, 1, 1, 1], [1, 1, 1, 0]], np.float32)
    net, goal = bigru.BiGru.fresh(), np.array([1.0, -2.0])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = net.inputs(lexicon)
    _, cache = net.forward(x, index, mask, keep=True)
    grads = net.backward(x, lexicon, index, cache, goal, np.zeros(len(x), bool))

    def value():
        return float(goal @ net.forward(net.inputs(lexicon), index, mask)[0])

    rng = np.random.default_rng(0)
    for name, p in net.p.items():
        used = np.argwhere(np.abs(grads[name]) > 1e-4)
        for spot in used[rng.permutation(len(used))[:6]]:
            spot = tuple(spot)
            old, step = p[spot], 1e-2
            p[spot] = old + step
            up = value()
            p[spot] = old - step
            slope = (up - value()) / (2 * step)
            p[spot] = old
            assert abs(slope - grads[name][spot]) < 0.02 * max(0.1, abs(slope)), (name, spot)


def test_windows_cover_every_word():
    counts = np.array([0, 1, 31, 32, 33, 56, 57, 500])
    text, first, size = toxicity.windows_of(counts)
    begin = np.cumsum(counts) - counts
    for i, n in enumerate(counts):
        met = {w for t, f, s in zip(text, first, size, strict=True) if t == i for w in range(f, f + s)}
        assert met == set(range(begin[i], begin[i] + n))
    assert size.max() <= toxicity.WINDOW


def test_a_word_anywhere_is_found():
    rng = np.random.default_rng(2)
    plain = [f"w{k}" for k in range(200)]
    texts, labels = [], []
    for i in range(300):
        text = list(rng.choice(plain, rng.integers(5, 150)))
        if i % 2:
            text[rng.integers(len(text))] = "vile" + rng.choice(["a", "bo", "cur"])
        texts.append(" ".join(text))
        labels.append(i % 2)
    model = toxicity.train(pa.table({"text": texts, "label": labels}), 0.5)
    tests = [" ".join([*rng.choice(plain, 700), "vilebo", *rng.choice(plain, 50)]), " ".join(rng.choice(plain, 700)), ""]
    bad, good, empty = toxicity._score(pa.array(tests), model).to_pylist()
    assert bad >= 0.5 > good and empty == 0.0


def test_long_runs_are_read_to_their_end():
    texts = ["ab " + "x" * 64 + " c", "y" * 65 + "z" * 100, "", "語" * 70, "a b"]
    whole = words.words_of(pa.array(texts))
    found = words.pieces_of(whole, 64, 24, 12)
    assert found.counts.tolist() == [3, 13, 0, 17, 2] and (found.ends - found.starts).max() == 64
    read = np.zeros(len(whole.data), bool)
    for a, b in zip(found.starts, found.ends, strict=True):
        read[a:b] = True
    assert all(read[a:b].all() for a, b in zip(whole.starts, whole.ends, strict=True))
    assert set(whole.hashes[:3].tolist()) <= set(found.hashes.tolist())
    same = words.words_of(pa.array(["one two", "three"]))
    assert words.pieces_of(same, 64, 24, 12) is same


def test_a_term_behind_a_long_unspaced_run_is_found():
    rng = np.random.default_rng(5)
    plain = [chr(k) for k in range(0x4E00, 0x4E00 + 60)]

    def text(toxic, size):
        run = list(rng.choice(plain, size))
        if toxic:
            at = int(rng.integers(30, size))
            run[at:at] = "殺死妳們"
        return "".join(run)

    texts = [text(i % 2, int(rng.integers(60, 200))) for i in range(400)]
    model = toxicity.train(pa.table({"text": texts, "label": [i % 2 for i in range(400)]}), 0.5)
    scores = toxicity._score(pa.array([text(i % 2, 400) for i in range(100)]), model).to_pylist()
    assert np.mean([(s >= 0.5) == i % 2 for i, s in enumerate(scores)]) > 0.9


def test_toxicity_of_held_out_documents(spark):
    found = queries.QUERIES["op4_toxicity"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic").distinct()
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_languages_of_held_out_documents(spark):
    found = queries.QUERIES["op8_language_id"](spark, DATA)
    true = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(true, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.005


def test_odd_texts(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs)
    rows = odd_docs.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()
    assert all(r.p.lang == "und" and r.p.score == 0 and r.p.rejected for r in rows if r.doc_id in (1, 2, 3))
    assert {r.p.lang for r in rows if r.doc_id in (5, 7)} <= {"en", "de"} and len(rows) == odd_docs.count()
    assert langid.fit(no_docs) is None
    none = odd_docs.select(langid.predict(F.col("text"), None).alias("p")).select("p.lang").distinct()
    assert [r.lang for r in none.collect()] == ["und"]
    labels = spark.createDataFrame([(5, 1), (6, None), (None, 0)], "doc_id long, toxic int")
    assert toxicity.fit(odd_docs, labels) is None
    scores = odd_docs.select(toxicity.score(F.col("text"), None).alias("s")).distinct().collect()
    assert [r.s for r in scores] == [0.0]
    assert no_docs.select(toxicity.score(F.col("text"), None)).isEmpty()


def test_the_sample_is_bounded_and_repeats(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.union(docs)
    labelled = docs.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    one, two = (labelled_sample(docs.repartition(n), labelled, 20, 100).to_pylist() for n in (2, 5))
    assert one == two and len(one) == 40
    assert labelled_sample(docs, labelled, 20, 3).num_rows == 0


def test_long_and_absent_documents_are_replaced_in_the_sample(spark):
    size = F.when(F.col("id") % 20 < 2, 5).otherwise(500).cast("int")
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text"))
    labelled = spark.range(4_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("label"))
    found = labelled_sample(docs, labelled.union(labelled), 60, 100).to_pydict()
    assert sorted(found["label"]) == [0] * 60 + [1] * 60 and set(found["text"]) == {"xxxxx"}


def test_only_letters_make_a_language(spark):
    texts = {"²": False, "½ ① Ⅷ² ³": True, "①②": False, "_12_": False, "12 é": True, "漢": True, "ª": True}
    texts["½ ① Ⅷ² ³"] = any(c.isalpha() for c in "½ ① Ⅷ² ³")
    assert {t: langid.has_letter(t) for t in texts} == texts
    model = langid.Model(["en"], np.zeros((langid.BUCKETS, 1)), np.zeros(1), 1.0, 0.0)
    found = langid._predict(pa.array(["²", "½", "①", "word"]), model).to_pylist()
    assert [r["lang"] for r in found] == ["und", "und", "und", "en"]
