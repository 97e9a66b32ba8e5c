"""Approximate nearest neighbours by inner product, over balanced posting lists.

Vectors get one more component that makes all lengths equal, so that the largest
inner product is the least distance. Centroids of balanced clusters are fitted on a
bounded sample; a graph over them is held in memory by each task. Every vector goes
to its nearest list, and if it lies near a border also to the others there. A query
searches the lists whose distance is within a ratio of its nearest list's; the
ratio is fitted on the sample for ``RECALL``. Lists and the queries that meet in them are
cut into blocks, so a task's share is bounded; products are exact, in double
precision.

Equal vectors are one entry with the ``k + 1`` smallest of their ids, as no answer
can hold more of them; equal queries are searched once. So a vector that fills a
third of the table costs one entry.

Vectors that are null, empty, zero or hold a null, NaN or infinity take no part,
nor do rows without an id. All vectors that take part must have one length: that
of most rows, the smaller in a tie. Rows of one id count once, with the smallest
vector. With k or fewer candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.centroid_graph import CentroidGraph, balanced_centroids
from tidewatch.llm.common import list_array, rest

#: Bounds of what is fitted: vectors of the sample and lists.
SAMPLE, MAX_LISTS = 20_000, 2_048
LIST_SIZE = 400
#: Neighbouring lists that one task searches together.
SHELF = 16
REPLICAS, BORDER = 3, 1.1
RECALL, TRIAL = 0.96, 400
#: A task holds so many bytes of entries, and so many queries.
BLOCK_BYTES, BLOCK_QUERIES = 1 << 24, 2_048
HIT_TYPE = "query long, score double, vec_id long"


@dataclass
class Index:
    graph: CentroidGraph
    longest: float  # squared length that all vectors are brought to
    ratio: float
    width: int
    scale: float = 1.0  # the largest absolute component: squares stay finite
    usual: float = 1e-12  # the squared distance from a query to its nearest list, as a median

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Queries get length 1 and a zero, entries what their length lacks."""
        if query:
            own = np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 1e-300)
            vectors = vectors / own
            length = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
            lifted = np.concatenate([vectors / length, np.zeros((len(vectors), 1))], axis=1)
        else:
            vectors = vectors / self.scale
            lack = np.maximum(self.longest - (vectors**2).sum(axis=1, keepdims=True), 0.0)
            lifted = np.concatenate([vectors, np.sqrt(lack)], axis=1) / np.sqrt(self.longest)
        return lifted.astype(np.float32)

    def lists_of_entries(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The nearest list, and up to ``REPLICAS`` in all about as near."""
        ids, d = self.graph.search(self.lift(vectors, False), REPLICAS)
        near = np.maximum(d, 0) <= BORDER**2 * np.maximum(d[:, :1], 1e-12)
        return [own[take] for own, take in zip(ids, near, strict=True)]

    def lists_of_queries(self, vectors: np.ndarray) -> list[np.ndarray]:
        ids, d = self.graph.search(self.lift(vectors, True), self.width)
        # A query that sits on a centroid would see no other list by the ratio alone.
        near = np.maximum(d, 0) <= self.ratio**2 * np.maximum(d[:, :1], self.usual)
        return [own[take] for own, take in zip(ids, near, strict=True)]


def takes_part(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def usable(table: DataFrame) -> DataFrame:
    """Rows vec_id, embedding (doubles), each id once, all of one length."""
    good = table.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding")))
    good = good.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    sizes = good.groupBy(F.size("embedding").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), "n").first()  # one row
    if common is None:
        return good
    same = good.where(F.size("embedding") == common["n"])
    return same.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def entries_of(vectors: DataFrame, k: int, every: int) -> DataFrame:
    """Rows entry, embedding, ids: equal vectors once, with their ``k + 1`` smallest ids."""
    key = F.xxhash64("embedding")
    keyed = vectors.withColumn("_key", key)
    # Cut to the first ranks before the shuffle, so a common vector stays small.
    rank = Window.partitionBy("_key", "embedding").orderBy("vec_id")
    first = keyed.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k + 1)
    grouped = first.groupBy("_key", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("entry"), "embedding", "ids")


def fit(entries: DataFrame, k: int) -> Index | None:
    number = entries.count()
    if not number:
        return None
    scale = entries.agg(F.max(F.array_max(F.transform("embedding", F.abs)))).first()[0]
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))
    longest = entries.agg(F.max(squares)).first()[0]
    chosen = entries.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE)
    sample = np.array(chosen.select("embedding").toArrow()["embedding"].to_pylist(), np.float64)
    lists = int(min(MAX_LISTS, max(1, number // LIST_SIZE), max(1, len(sample) // 4)))
    index = Index(None, float(longest), 1.0, 1, float(scale))
    lifted = index.lift(sample, False)
    centroids = balanced_centroids(lifted, lists)
    shelves = balanced_centroids(centroids, -(-len(centroids) // SHELF))
    away = (shelves**2).sum(axis=1) - 2 * centroids @ shelves.T
    # Neighbours get neighbouring numbers, and so stand on one shelf.
    index.graph = CentroidGraph.build(centroids[np.argsort(away.argmin(axis=1), kind="stable")])
    _fit_ratio(index, sample, k)
    return index


def _fit_ratio(index: Index, sample: np.ndarray, k: int) -> None:
    """The least ratio that finds ``RECALL`` of the sample's own neighbours, and a
    search width that has room for all lists within it."""
    lists = len(index.graph.centroids)
    trial = sample[:: max(1, len(sample) // TRIAL)][:TRIAL]
    homes = index.lists_of_entries(sample)
    ids, d = index.graph.search(index.lift(trial, True), lists)
    index.usual = float(max(1e-12, np.median(d[:, 0])))
    away = np.sqrt(np.maximum(d, 0) / np.maximum(d[:, :1], index.usual))
    position = np.full((len(trial), lists), np.inf)
    np.put_along_axis(position, ids, away, axis=1)
    needed = [
        position[i, homes[j]].min()
        for i, row in enumerate((trial / index.scale) @ (sample / index.scale).T)
        for j in np.argsort(-row)[1 : k + 1]
    ]
    index.ratio = float(np.quantile(needed, RECALL, method="higher")) if needed else 1.0
    within = (away <= index.ratio).sum(axis=1)
    index.width = int(min(lists, 8 + 1.25 * within.max()))


def _postings(batches: Iterator[pa.RecordBatch], index: Index, query: bool) -> Iterator[pa.RecordBatch]:
    """Each vector's lists, one row per shelf of neighbouring lists."""
    for batch in batches:
        for a in range(0, batch.num_rows, 2048):
            part = batch.slice(a, 2048)
            vectors = _matrix(part.column("embedding"))
            found = index.lists_of_queries(vectors) if query else index.lists_of_entries(vectors)
            rows = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
            lists = np.concatenate(found)
            order = np.lexsort((lists, rows))
            rows, lists = rows[order], lists[order]
            shelf = lists // SHELF
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (shelf[1:] != shelf[:-1])
            begin = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("entry").take(pa.array(rows[begin])),
                    pa.array(shelf[begin], pa.int32()),
                    list_array(lists, np.diff(np.append(begin, len(rows))), pa.int32()),
                ],
                ["entry", "shelf", "lists"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _placed(entries: DataFrame, index, query: bool, block: int) -> DataFrame:
    """Rows placed, shelf, lists, block, blocks."""
    slim = entries.select("entry", "embedding")
    places = rest(
        slim.mapInArrow(
            lambda b: _postings(b, index.value, query), "entry long, shelf int, lists array<int>"
        ),
        "ann_places",
    )
    # One row per shelf: MAX_LISTS / SHELF at most, whatever the table's size.
    sizes = places.groupBy("shelf").count()
    cut = sizes.select(
        F.col("shelf").alias("of"), F.ceil(F.col("count") / block).cast("int").alias("blocks")
    )
    sized = places.join(F.broadcast(cut), F.col("shelf") == F.col("of")).drop("of")
    own = F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int")
    return sized.withColumn("block", own).withColumnRenamed("entry", "placed")


def best_columns(scores: np.ndarray, first: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``keep`` largest of each row, and of all that equal the last.

    Columns whose score differs by rounding alone count as equal.
    """
    if scores.shape[1] <= keep:
        return tuple(np.indices(scores.shape).reshape(2, -1))
    edge = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
    # A product of large finite vectors may be infinite.
    slack = np.where(np.isfinite(edge), 1e-9 * np.maximum(1.0, np.abs(edge)), 0.0)
    row, column = np.nonzero(scores >= (edge - slack)[:, None])
    crowded = np.flatnonzero(np.bincount(row, minlength=len(scores)) > 4 * keep)
    for i in crowded:  # very many ties: ids decide between them
        mine = column[row == i]
        above = scores[i, mine] > edge[i] + slack[i]
        tied = mine[~above]
        chosen = np.concatenate([mine[above], tied[np.argsort(first[tied], kind="stable")[:keep]]])
        other = row != i
        row = np.concatenate([row[other], np.full(len(chosen), i)])
        column = np.concatenate([column[other], chosen])
    return row, column


def _members(lists: pa.Array) -> dict[int, np.ndarray]:
    """The rows that stand in each list."""
    owner = np.repeat(np.arange(len(lists)), np.diff(offsets_of_list(lists)))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(flat, kind="stable")
    names, begin = np.unique(flat[order], return_index=True)
    return dict(zip(names.tolist(), np.split(owner[order], begin[1:]), strict=True))


def offsets_of_list(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy()


def search_shelf(queries, asked, entries, held, ids, keep: int):
    """(query row, score, id) of each query's ``keep`` best in the lists it asks for."""
    size = np.array([len(i) for i in ids], np.int64)
    flat = np.array([x for i in ids for x in i], np.int64)
    begin = np.cumsum(size) - size
    first = flat[begin]
    rows, columns = [], []
    for name in asked.keys() & held.keys():
        who, where = asked[name], held[name]
        for a in range(0, len(who), 512):
            products = queries[who[a : a + 512]] @ entries[where].T
            row, column = best_columns(products, first[where], keep)
            rows.append(who[a + row])
            columns.append(where[column])
    if not rows:
        return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    # A vector found in several lists of the shelf counts once.
    pairs = np.unique(np.concatenate(rows) * len(ids) + np.concatenate(columns))
    row, column = pairs // len(ids), pairs % len(ids)
    score = np.empty(len(row))
    for a in range(0, len(row), 1 << 14):
        part = slice(a, a + (1 << 14))
        score[part] = (queries[row[part]] * entries[column[part]]).sum(axis=1)
    many = size[column]
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    found = flat[np.repeat(begin[column], many) + place]
    row, score = np.repeat(row, many), np.repeat(score, many)
    order = np.lexsort((found, -score, row))
    row, score, found = row[order], score[order], found[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    kept = rank < keep
    return row[kept], score[kept], found[kept]


def _search(left: pa.Table, right: pa.Table, keep: int) -> pa.Table:
    kinds = {"query": pa.int64(), "score": pa.float64(), "vec_id": pa.int64()}
    if not left.num_rows or not right.num_rows:
        return pa.schema(kinds).empty_table()
    left, right = left.combine_chunks(), right.combine_chunks()
    column = lambda t, c: t[c].chunk(0)
    row, score, found = search_shelf(
        _matrix(column(left, "embedding")),
        _members(column(left, "lists")),
        _matrix(column(right, "embedding")),
        _members(column(right, "lists")),
        right["ids"].to_pylist(),
        keep,
    )
    queries = column(left, "entry").take(pa.array(row))
    return pa.table([queries, pa.array(score), pa.array(found)], schema=pa.schema(kinds))


def nearest(table: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Rows query_id, rank, vec_id, score: for each id divisible by ``every``, its k nearest."""
    vectors = rest(usable(table), "ann_vectors")
    entries = rest(entries_of(vectors, k, every), "ann_entries")
    fitted = fit(entries, k)
    asked = vectors.where(F.col("vec_id") % every == 0)
    if fitted is None:
        empty = "query_id long, rank int, vec_id long, score double"
        return table.sparkSession.createDataFrame([], empty)
    index = table.sparkSession.sparkContext.broadcast(fitted)  # MAX_LISTS vectors
    # Each asked vector once, under its smallest asked id.
    asked = asked.withColumn("_key", F.xxhash64("embedding"))
    once = asked.groupBy("_key", "embedding").agg(F.min("vec_id").alias("entry"))
    once = rest(once.select("entry", "embedding"), "ann_queries")
    names = (
        asked.select("vec_id", "embedding")
        .join(once.withColumnRenamed("embedding", "of"), F.col("embedding") == F.col("of"))
        .select(F.col("vec_id").alias("query_id"), "entry")
    )
    width = fitted.graph.centroids.shape[1]
    posted = _placed(entries, index, False, max(16, BLOCK_BYTES // (8 * width)))
    wanted = _placed(once, index, True, BLOCK_QUERIES)
    # Each block of a shelf's queries meets each block of its entries once.
    entry_blocks = posted.groupBy("shelf").agg(F.max("blocks").alias("other"))
    query_blocks = wanted.groupBy("shelf").agg(F.max("blocks").alias("other"))

    def meet(side: DataFrame, others: DataFrame, vectors: DataFrame, names: tuple[str, str]):
        others = F.broadcast(others.withColumnRenamed("shelf", "of"))  # one row per shelf
        spread = side.join(others, F.col("shelf") == F.col("of"))
        spread = spread.withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
        spread = spread.withColumnRenamed("block", names[0]).drop("of", "other", "blocks")
        return spread.join(vectors, F.col("placed") == F.col("entry")).drop("placed")

    left = meet(wanted, entry_blocks, once, ("q", "e"))
    right = meet(posted, query_blocks, entries, ("e", "q"))
    group = ["shelf", "q", "e"]
    hits = (
        left.groupBy(*group)
        .cogroup(right.groupBy(*group))
        .applyInArrow(lambda a, b: _search(a, b, k + 1), HIT_TYPE)
    )
    hits = hits.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    others = names.join(best, F.col("entry") == F.col("query")).where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
