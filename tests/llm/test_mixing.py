import pytest
from pyspark.sql import functions as F

from tidewatch.llm import mixing


def brute(sizes, weights, limit=3.0):
    """Water-filling by repeated cutting, on plain lists."""
    total, cut = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in cut]
        left = total - sum(limit * sizes[i] for i in cut)
        share = left / sum(weights[i] for i in free) if free else 0
        more = {i for i in free if weights[i] * share >= limit * sizes[i]}
        if not more:
            return [limit * s if i in cut else weights[i] * share for i, s in enumerate(sizes)]
        cut |= more


def docs(spark, sizes):
    rows = [(i * 1000 + k, "w " * 10, s) for i, (s, n) in enumerate(sizes) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize(
    "sizes", [[("a", 40), ("b", 1), ("c", 2)], [("é", 3), (None, 5), ("Z", 300), ("z", 1)], [("a", 1)]]
)
def test_targets_are_water_filled(spark, sizes):
    planned = mixing.plan(docs(spark, sizes)).select("source", "_mix.*").collect()
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    want = brute([10 * n for _, n in ordered], [1 + i % 3 for i in range(len(ordered))])
    got = {r.source: r.target for r in planned}
    assert [got[s] for s, _ in ordered] == pytest.approx(want)
    assert all(0 <= r.copies <= 3 for r in planned)


def test_the_mix_comes_near_its_targets_and_repeats(spark):
    table = docs(spark, [("a", 900), ("b", 400), (None, 900)])
    rows = mixing.plan(table).select("doc_id", "source", "_mix.*").collect()
    for source in ("a", "b", None):
        own = [r for r in rows if r.source == source]
        assert sum(r.size * r.copies for r in own) == pytest.approx(own[0].target, rel=0.1)
    again = mixing.plan(table.repartition(7)).select("doc_id", "source", "_mix.*").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    mixed = mixing.mix(table)
    assert mixed.count() == sum(r.copies for r in rows)
    copies = mixed.groupBy("doc_id").agg(F.max("copy").alias("m"), F.count("*").alias("n"))
    assert copies.where("m <> n").isEmpty()


@pytest.mark.parametrize("parts", [1, 5])
def test_equal_rows_share_their_copies(spark, parts):
    """A source of one row repeated, one of mixed repeats, and one of single rows."""
    same = [(1, "w " * 5, "a", n) for n in range(400)]
    mixed = [(10 + k, "w " * (k + 1), "b", n) for k in range(30) for n in range(k % 7 + 1)]
    single = [(100 + n, "w " * 5, "c", n) for n in range(300)]
    table = spark.createDataFrame(same + mixed + single, "doc_id long, text string, source string, n int")
    rows = mixing.plan(table.repartition(parts, "n")).collect()
    assert len(rows) == table.count()
    for source in "abc":
        own = [r for r in rows if r.source == source]
        taken = sum(r._mix.size * r._mix.copies for r in own)
        assert taken == pytest.approx(own[0]._mix.target, rel=0.02)
        rate = own[0]._mix.target / own[0]._mix.source_size
        for doc_id in {r.doc_id for r in own}:
            copies = [r._mix.copies for r in own if r.doc_id == doc_id]
            # All rows of a document together: the whole part, and one by the draw.
            extra = sum(copies) - len(copies) * int(rate)
            assert int((rate % 1) * len(copies)) <= extra <= int((rate % 1) * len(copies)) + 1
            assert {int(rate)} <= set(copies) | {int(rate)} <= {int(rate), int(rate) + 1}


def test_the_number_taken_of_a_document_does_not_depend_on_partitions(spark):
    rows = [(k % 40, "w " * (k % 40 + 1), "ab"[k % 40 % 2], k) for k in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")

    def taken(df):
        found = mixing.plan(df).groupBy("doc_id").agg(F.sum("_mix.copies").alias("c"))
        return {r.doc_id: r.c for r in found.collect()}

    assert taken(table) == taken(table.repartition(9, "n")) == taken(table.coalesce(1))


def test_columns_of_any_name_stay(spark):
    table = spark.createDataFrame(
        [(1, "a b", "s", 5, 6, 7.0, 8), (1, "a b", "s", 5, 6, 7.0, 9)],
        "doc_id long, text string, source string, rows int, _document int, rate double, _number int",
    )
    planned = mixing.plan(table)
    assert planned.columns == [*table.columns, "_mix"]
    assert sorted(r._number for r in planned.collect()) == [8, 9]


def test_sizes_are_words(spark):
    text = spark.createDataFrame([(" a\tb\n\x0bc d ",), ("",), (None,)], "text string")
    assert [r[0] for r in text.select(mixing.word_count(F.col("text"))).collect()] == [3, 0, 0]


def test_odd_rows(odd_docs, no_docs):
    planned = mixing.plan(odd_docs)
    assert planned.count() == odd_docs.count()
    assert {r[0] for r in planned.where("text is null").select("_mix.size").collect()} == {0}
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == [*odd_docs.columns, "copy"]
    assert mixing.plan(no_docs).isEmpty() and mixing.mix(no_docs).isEmpty()


def test_few_unequal_documents_come_near_their_targets(spark):
    rows = [
        (s * 100 + k, "w " * (2 ** (k % 10) + k), f"s{s}", k) for s in range(6) for k in range(50)
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, seed long")
    planned = mixing.plan(table)
    assert planned.columns == [*table.columns, "_mix"]
    per_source = planned.groupBy("source").agg(
        F.sum(F.col("_mix.size") * F.col("_mix.copies")).alias("taken"),
        F.first("_mix.target").alias("target"),
    )
    for row in per_source.collect():
        assert row.taken == pytest.approx(row.target, rel=0.05)
