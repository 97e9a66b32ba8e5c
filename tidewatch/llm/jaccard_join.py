"""N-gram Jaccard join by MinHash banding.

1. Each text becomes the set of its five-word shingles (64-bit hashes). Texts
   with equal sets are one *node*, whatever their number, so a large group of
   copies is one row from here on (combined before the shuffle).
2. Each node's MinHash signature is cut into bands; the numbers of bands and rows
   are chosen for the target recall at the threshold. Nodes are shuffled by band hash, and each
   is tied to the smallest node of its bucket: one edge per member, not per pair.
3. Components of these edges hold every pair that shares a band. Their texts are
   brought together and all pairs inside are verified on the full shingle sets
   by block-wise incidence products. A component too large for one task is cut into blocks
   by hash, and tasks take pairs of blocks; a task returns counts and a
   spanning forest, never the pairs.
4. Verified links give each node its number of linked documents, and its class:
   the connected component.

A text of one to four words is one shingle. Null, empty and wordless texts are
like nothing: each is its own class with no link. Repeated rows are copies of
each other. A node is known by 64 bits of its set's digest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words
from tidewatch.llm.common import chunks, list_array, rest, text_udf
from tidewatch.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_BANDS = 48
#: A block holds about so many nodes, or so many shingles if that is reached first.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 20
SIGNATURE_TYPE = "struct<node:long,n_shingles:int,bands:array<long>>"
VERIFIED_TYPE = "node long, links long, root long"


def choose_bands(threshold: float, recall: float, max_bands: int = MAX_BANDS) -> tuple[int, int]:
    """Bands and rows: the most rows for which few enough bands reach the recall.

    A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands.
    More rows let fewer dissimilar pairs through.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands > max_bands:
            break
        best = (bands, rows)
    return best


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return words.distinct_per_text(*words.shingles_of(words.words_of(column), SHINGLE))


def _node_ids(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The digest of each set; meaningless where a set is empty."""
    ids = np.zeros(len(number), np.uint64)
    full = np.flatnonzero(number)
    if len(full):
        begin = (np.cumsum(number) - number)[full]
        ids[full] = words.mix(np.add.reduceat(words.mix(values, 3), begin), 4)
    return ids.view(np.int64)


def _signatures(column: pa.Array, bands: int, rows: int) -> pa.Array:
    values, number = _sets(column)
    ids = _node_ids(values, number)
    full = np.flatnonzero(number)
    keys = np.zeros((len(full), bands), np.uint64)
    if len(full):
        begin = (np.cumsum(number) - number)[full]
        short = (values >> np.uint64(32)).astype(np.uint32)
        rng = np.random.default_rng(11)
        factors = rng.integers(0, 1 << 31, bands * rows, np.uint32) * np.uint32(2) + np.uint32(1)
        masks = rng.integers(0, 1 << 32, bands * rows, np.uint32)
        for k in range(bands * rows):
            hashed = (short ^ masks[k]) * factors[k]
            least = np.minimum.reduceat(hashed, begin).astype(np.uint64)
            keys[:, k // rows] += words.mix(least, 100 + k)
    lengths = np.zeros(len(number), np.int64)
    lengths[full] = bands
    return pa.StructArray.from_arrays(
        [
            pa.array(ids, pa.int64(), mask=number == 0),
            pa.array(number.astype(np.int32)),
            list_array(words.mix(keys).view(np.int64).ravel(), lengths, pa.int64()),
        ],
        ["node", "n_shingles", "bands"],
    )


def _only_nodes(column: pa.Array) -> pa.Array:
    values, number = _sets(column)
    return pa.array(_node_ids(values, number), pa.int64(), mask=number == 0)


def node_of(text: Column) -> Column:
    """The text's shingle set as 64 bits; null for a text without words."""
    return text_udf(_only_nodes, "long")(text)


def signatures(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    bands, rows = choose_bands(threshold, recall)
    signed = text_udf(lambda part: _signatures(part, bands, rows), SIGNATURE_TYPE)
    return docs.select("doc_id", signed(F.col("text")).alias("s")).select("doc_id", "s.*")


def candidate_components(nodes: DataFrame) -> DataFrame:
    """Rows node, root for nodes that share a band with another."""
    members = nodes.select("node", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n"))
    shared = buckets.where("n > 1").select(F.col("key").alias("shared_key"), "first")
    tied = members.join(shared, F.col("key") == F.col("shared_key")).where("node != first")
    edges = tied.select(F.col("node").alias("a"), F.col("first").alias("b"))
    return connected_components(edges, "jaccard_candidates")


def _verify_group(nodes, copies, blocks, low, high, sets, threshold):
    """Linked documents and the forest's root of each node of one pair of blocks."""
    size = np.array([len(s) for s in sets], np.float64)
    column = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    _, place, often = np.unique(column, return_inverse=True, return_counts=True)
    shared = often[place] > 1
    number = np.cumsum(often > 1) - 1
    place, row = number[place[shared]], row[shared]
    common = np.zeros((len(sets), len(sets)))
    step = max(1, min((1 << 22) // len(sets), int((often > 1).sum())))
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    for first in range(0, int(place[-1]) + 1 if len(place) else 0, step):
        part = slice(*np.searchsorted(place, [first, first + step]))
        incidence = np.zeros((len(sets), step), np.float32)
        incidence[row[part], place[part] - first] = 1
        common += incidence @ incidence.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if low != high:
        linked &= blocks[:, None] != blocks[None, :]
    links = linked @ copies
    root = np.arange(len(sets))
    for i in range(len(sets)):
        if root[i] != i:
            continue
        reach = np.zeros(len(sets), bool)
        reach[i] = True
        while True:
            more = reach | linked[reach].any(axis=0)
            if (more == reach).all():
                break
            reach = more
        root[reach] = i
    return links, nodes[root]


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Groups stand one after the other, sorted by (root, low, high)."""

    def done(group: list) -> pa.RecordBatch:
        once = {row[0]: row for row in group}  # a repeated row of the table
        rows = list(once.values())
        nodes = np.array([r[0] for r in rows], np.int64)
        copies = np.array([r[1] for r in rows], np.int64)
        blocks = np.array([r[2] for r in rows], np.int64)
        links, roots = _verify_group(
            nodes, copies, blocks, key[1], key[2], [r[3] for r in rows], threshold
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(links.astype(np.int64)), pa.array(roots)],
            ["node", "links", "root"],
        )

    key, group = None, []
    for batch in batches:
        keys = list(
            zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high")), strict=True)
        )
        nodes = batch.column("node").to_pylist()
        copies, blocks = batch.column("copies").to_pylist(), batch.column("block").to_pylist()
        at = 0
        for part in chunks(batch.column("text").fill_null("")):
            values, number = _sets(part)
            ends, ids = np.cumsum(number), _node_ids(values, number)
            for i in range(len(part)):
                row = at + i
                if keys[row] != key:
                    if group:
                        yield done(group)
                    key, group = keys[row], []
                if ids[i] == nodes[row]:  # else another text under the same id
                    mine = values[ends[i] - number[i] : ends[i]].copy()
                    group.append((nodes[row], copies[row], blocks[row], mine))
            at += len(part)
    if group:
        yield done(group)


def verified(docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows node, links, root: partial counts and forest edges from every task."""
    roots = candidate_components(nodes).withColumnRenamed("node", "member")
    members = rest(
        nodes.join(roots, F.col("node") == F.col("member")).select(
            "node", "copies", "n_shingles", "first_id", "root"
        ),
        "jaccard_members",
    )
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    cuts = F.greatest(
        F.ceil(F.col("n") / BLOCK_NODES), F.least(F.ceil(F.col("w") / BLOCK_SHINGLES), F.col("n"))
    )
    sizes = sizes.select(F.col("root").alias("of"), cuts.cast("int").alias("cuts"))
    block = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    placed = members.join(sizes, F.col("root") == F.col("of")).withColumn("block", block)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    # Members grow with the table, so they are never broadcast, however few they are here.
    placed = placed.hint("shuffle_merge")
    found = texts.join(placed, F.col("doc_id").eqNullSafe(F.col("first_id")))
    # A member meets its own block and every other one exactly once.
    partner = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    paired = found.withColumn("partner", partner).select(
        "node",
        "copies",
        "block",
        "root",
        F.least("block", "partner").alias("low"),
        F.greatest("block", "partner").alias("high"),
        "text",
    )
    keys = ["root", "low", "high"]
    grouped = paired.repartition(*keys).sortWithinPartitions(*keys, "node")
    return grouped.mapInArrow(lambda batches: _verify(batches, threshold), VERIFIED_TYPE)


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL):
    """(signatures, nodes): each document's node, and each node's links and class.

    ``nodes`` has node, copies, first_id, links (to documents of other nodes) and
    root, the class.
    """
    signed = rest(signatures(docs, threshold, recall), "jaccard_signatures")
    nodes = rest(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "jaccard_nodes",
    )
    found = rest(verified(docs, nodes, threshold), "jaccard_verified")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    forest = found.where("node != root").select(
        F.col("node").alias("a"), F.col("root").alias("b")
    )
    roots = connected_components(forest, "jaccard_classes")
    counts = counts.withColumnRenamed("node", "counted")
    roots = roots.select(F.col("node").alias("rooted"), "root")
    joined = (
        nodes.drop("bands")
        .join(counts, F.col("node") == F.col("counted"), "left")
        .join(roots, F.col("node") == F.col("rooted"), "left")
    )
    return signed, joined.select(
        "node",
        "copies",
        "first_id",
        F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "node").alias("root"),
    )


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Rows doc_id, class_id, n_links, n_copies: one per document.

    ``class_id`` is the smallest id of the documents that links connect with it,
    ``n_links`` the number of other documents at or above the threshold, copies
    included, ``n_copies`` the documents with the same shingle set, itself included.
    """
    signed, nodes = classes(docs, threshold, recall)
    nodes = rest(nodes, "jaccard_linked")
    names = nodes.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = nodes.join(names, "root").select(
        F.col("node").alias("of"), "class_id", "links", "copies"
    )
    joined = signed.join(named, F.col("node") == F.col("of"), "left")
    return joined.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest id.

    Rows that tie (the same id and shingle set) give the smallest by all columns.
    Texts without words all stay.
    """
    _, nodes = classes(docs, threshold, recall)
    order = F.struct(F.col("first_id").isNull(), "first_id", "node")
    kept = rest(
        nodes.groupBy("root")
        .agg(F.min(order).alias("k"))
        .select(F.col("k.first_id").alias("_kept_id"), F.col("k.node").alias("_kept_node")),
        "jaccard_kept",
    )
    # The table's columns travel in one struct, so that none clashes with a working column.
    row = F.struct(*docs.columns).alias("_row")
    marked = docs.select(row, F.col("doc_id").alias("_id"), node_of(F.col("text")).alias("_node"))
    same = (F.col("_node") == F.col("_kept_node")) & F.col("_id").eqNullSafe(F.col("_kept_id"))
    once = marked.join(kept, same).groupBy("_node").agg(F.min("_row").alias("_row"))
    return once.select("_row.*").unionByName(marked.where(F.col("_node").isNull()).select("_row.*"))
