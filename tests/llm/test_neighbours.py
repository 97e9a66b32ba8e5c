import numpy as np
import pytest

from tidewatch.llm import neighbours as n

SMALL = "/root/testdata/sf0.1/embeddings.parquet"


def exact(rows, k, every=20):
    """Per query the ids in order, by brute force in double precision."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = (vectors * vectors[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def collected(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet(SMALL)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = exact(rows, 20), collected(n.nearest(table))
    assert set(got) == set(want)
    score = {q: dict(v) for q, v in exact(rows, len(rows)).items()}
    hits = 0
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(s == pytest.approx(score[q][i], abs=1e-12) for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_equal_vectors_and_ties_go_by_id(spark):
    rng = np.random.default_rng(1)
    common = [1.0, 0.0, 0.0, 0.0]
    rows = [(i, common) for i in range(0, 300)]
    rows += [(i, [float(x) for x in rng.integers(-2, 3, 4)] if i % 7 else [0.0, 1.0, 0.0, 0.0]) for i in range(300, 400)]
    rows = [(i, v) for i, v in rows if any(v)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collected(n.nearest(table, k=20))
    want = exact(rows, 20)
    assert got[0] == want[0] and got[280] == want[280] and set(got) == set(want)


def test_what_takes_no_part(spark):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
           (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0])]
    good = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [0.5, 0.5]), (40, [0.0, 1.0])]
    table = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>")
    assert collected(n.nearest(table)) == {20: [(21, 0.5), (40, 0.0)], 40: [(21, 0.5), (20, 0.0)]}
    assert n.nearest(table.limit(0)).isEmpty()
    assert n.nearest(table.where("vec_id < 7")).isEmpty()


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(n, "BLOCK_BYTES", 50 * 8 * 65)
    monkeypatch.setattr(n, "BLOCK_QUERIES", 3)
    table = spark.read.parquet(SMALL).where("vec_id < 400")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = collected(n.nearest(table, k=5))
    # One list: the search is exact however it is cut.
    assert {q: [i for i, _ in v] for q, v in got.items()} == {
        q: [i for i, _ in v] for q, v in exact(rows, 5).items()
    }


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_large_and_small_finite_vectors(spark, size):
    """Squares overflow or vanish; the search and its scores do not fail."""
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=8) * size).tolist()) for i in range(60)]
    rows += [(100 + i, draw.normal(size=8).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collected(n.nearest(table, k=5))
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    want = exact(rows, 5)
    for query, hits in found.items():
        assert len(hits) == 5
        assert [s for _, s in hits] == pytest.approx([s for _, s in want[query]], rel=1e-9) or query < 100


def test_columns_that_clash_stay_out_of_the_way(spark):
    rows = [(i, [float(i), 1.0], 1, 2, 3.0) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, entry int, rank int, score double")
    assert len(collected(n.nearest(table, k=3))[20]) == 3
