"""Find benchmark passages in documents by latent semantic retrieval.

Documents and benchmark items are cut into passages. The words of the benchmark
that are rare in the corpus (and the rarest of each item, rare or not) are the index
terms, weighted by their inverse document frequency over all passages. A
randomised SVD of the TF-IDF passages gives a latent space; Spark tasks multiply all
passages of the corpus, the benchmark's are added with a weight that lets them lead. Passages near an item by cosine are
candidates. A candidate is confirmed by the longest common subsequence of words
with the whole item, and between ``PARAPHRASE`` and ``COPY`` by finding the item's
answer too: what follows ``Answer:``, else its last sentence.

A candidate has two index terms of the benchmark, or one for an item that has no more.
Passages are ``2 * HALF`` words long and overlap by half. Candidates are first held
against an upper bound of the subsequence, which loses none. The benchmark is
worked in blocks of a bounded number of passages, so what the driver and each
task hold is bounded; the number of passes grows with the benchmark.

Null, empty and wordless texts match nothing, on either side. Repeated rows are
judged alike. An empty benchmark matches nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import words
from tidewatch.llm.common import chunks, list_array, rest, segment_sums, segments, text_udf

HALF = 32
BLOCK_PASSAGES = 256
#: A benchmark word in more than this share of half passages is an index term only
#: where an item has fewer than MIN_TERMS rarer ones.
MAX_SHARE, MIN_TERMS = 0.01, 8
#: The benchmark's energy against the corpus's; dimensions kept, and drawn beyond them.
ITEM_ENERGY, RANK, OVERSAMPLE = 4.0, 128, 16
COSINE = 0.45
COPY, PARAPHRASE = 0.8, 0.6
ROW_CHUNK = 512
HIT_TYPE = "array<struct<item_id:long,cosine:double,coverage:double,answer:boolean>>"
_ANSWER = re.compile(r"(?is)\banswer\s*:\s*(.+)$")
_SENTENCE = re.compile(r"[^.!?\n]*\w[^.!?\n]*")


@dataclass
class Block:
    """Benchmark items as word hashes, and the vocabulary of their words."""

    ids: list
    items: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes
    passage_item: np.ndarray
    passage_terms: list[np.ndarray]  # positions in the vocabulary


@dataclass
class Space:
    """Index terms, their latent vectors, and the unit vectors of item passages."""

    block: Block
    terms: np.ndarray  # sorted hashes
    project: np.ndarray  # terms x rank
    targets: np.ndarray  # rank x passages
    least: np.ndarray  # of each item passage: index terms that a candidate has at least


def answer_of(text: str) -> str:
    found = _ANSWER.search(text)
    if found:
        return found.group(1)
    sentences = _SENTENCE.findall(text)
    return sentences[-1] if sentences else ""


def _split(column: pa.Array) -> list[np.ndarray]:
    found = words.words_of(column)
    return np.split(found.hashes, np.cumsum(found.counts)[:-1]) if len(column) else []


def make_block(rows: list[tuple]) -> Block:
    ids, items, answers = [], [], []
    texts = [t for _, t in rows]
    split = _split(pa.array(texts, pa.string()))
    solved = _split(pa.array([answer_of(t) for t in texts], pa.string()))
    for (item_id, _), item, answer in zip(rows, split, solved, strict=True):
        if len(item):
            ids.append(item_id)
            items.append(item)
            answers.append(answer)
    vocabulary = np.unique(np.concatenate(items)) if items else np.empty(0, np.uint64)
    passage_item, passage_terms = [], []
    for i, item in enumerate(items):
        for first in range(0, len(item), 2 * HALF):
            part = np.unique(item[first : first + 2 * HALF])
            passage_item.append(i)
            passage_terms.append(np.searchsorted(vocabulary, part))
    return Block(ids, items, answers, vocabulary, np.array(passage_item), passage_terms)


def blocks_of(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks, read row by row; one block is held at a time."""
    rows, passages = [], 0
    given = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    for row in given.orderBy("item_id", "text").toLocalIterator():
        rows.append((row["item_id"], row["text"]))
        passages += 1 + len(row["text"].split()) // (2 * HALF)
        if passages >= BLOCK_PASSAGES:
            yield make_block(rows)
            rows, passages = [], 0
    if rows:
        yield make_block(rows)


def _term_hits(found: words.Words, terms: np.ndarray):
    """(half passage, term) pairs, each once and sorted, and half passages per text.

    Half passages are numbered through all texts of the slice.
    """
    halves = -(-found.counts // HALF)
    if len(found.hashes) == 0 or len(terms) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), halves
    sieve = np.zeros(1 << 16, bool)
    sieve[(terms >> np.uint64(48)).astype(np.int64)] = True
    near = np.flatnonzero(sieve[(found.hashes >> np.uint64(48)).astype(np.int64)])
    place = np.minimum(np.searchsorted(terms, found.hashes[near]), len(terms) - 1)
    hit = terms[place] == found.hashes[near]
    near, place = near[hit], place[hit]
    begin = np.cumsum(found.counts) - found.counts
    first = np.cumsum(halves) - halves
    owner = np.searchsorted(np.cumsum(found.counts), near, side="right")
    half = first[owner] + (near - begin[owner]) // HALF
    pairs = np.unique(half * len(terms) + place)
    return pairs // len(terms), pairs % len(terms), halves


INDEX_TYPE = "struct<sizes:array<int>,terms:array<int>>"


def _index_text(column: pa.Array, vocabulary: np.ndarray) -> pa.Array:
    """Of each text its words of the vocabulary: per half passage, each once."""
    half, term, halves = _term_hits(words.words_of(column), vocabulary)
    sizes = np.bincount(half, minlength=int(halves.sum()))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    last = np.cumsum(halves)
    counts = ends[last] - ends[last - halves]
    return pa.StructArray.from_arrays(
        [
            list_array(sizes.astype(np.int32), halves, pa.int32()),
            list_array(term.astype(np.int32), counts, pa.int32()),
        ],
        ["sizes", "terms"],
    )


def index_of(docs: DataFrame, block: Block) -> DataFrame:
    """Rows sizes, terms: the corpus as the block's vocabulary sees it."""
    given = docs.sparkSession.sparkContext.broadcast(block.vocabulary)  # bounded by the block
    indexed = text_udf(lambda part: _index_text(part, given.value), INDEX_TYPE)
    return rest(docs.select(indexed(F.col("text")).alias("i")).select("i.*"), "decontaminate_index")


def _count_terms(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    seen, total = np.zeros(width, np.int64), 0
    for batch in batches:
        total += len(batch.column(0).flatten())
        seen += np.bincount(batch.column(1).flatten().to_numpy(), minlength=width)
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], used]), pa.int64()),
            pa.array(np.concatenate([[total], seen[used]]), pa.int64()),
        ],
        ["term", "n"],
    )


def frequencies(index: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """How many half passages of the corpus have each word of the vocabulary, and their number."""
    counted = index.mapInArrow(lambda batches: _count_terms(batches, width), "term long, n long")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # the vocabulary at most
    seen, total = np.zeros(width, np.int64), 0
    for term, n in zip(rows["term"].to_pylist(), rows["n"].to_pylist(), strict=True):
        if term < 0:
            total = n
        else:
            seen[term] = n
    return seen, total


def choose_terms(block: Block, seen: np.ndarray, total: int) -> np.ndarray:
    """Positions in the vocabulary of the index terms, ascending."""
    rare = seen <= MAX_SHARE * total
    for terms in block.passage_terms:
        if rare[terms].sum() < MIN_TERMS:
            rare[terms[np.argsort(seen[terms], kind="stable")[:MIN_TERMS]]] = True
    return np.flatnonzero(rare)


def _multiply(
    batches: Iterator[pa.RecordBatch], chosen: np.ndarray, weight: np.ndarray, basis: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """This task's share of A'A·basis, A being the passages; in chunks of rows.

    ``chosen`` gives a word of the vocabulary its index term, or -1.
    """
    out = np.zeros(basis.shape, np.float32)
    mapped = (weight[:, None] * basis).astype(np.float32)
    energy = (weight**2).astype(np.float32)
    number = 0
    for batch in batches:
        sizes = batch.column(0).flatten().to_numpy()
        halves = np.diff(batch.column(0).offsets.to_numpy())
        term = chosen[batch.column(1).flatten().to_numpy()]
        # A gap between texts, so that no passage spans two of them.
        place = np.repeat(np.arange(len(sizes)) + segments(halves), sizes)
        place, term = place[term >= 0], term[term >= 0]
        for a in range(0, len(term), 1 << 15):
            number += _multiply_part(term, place, a, 1 << 15, mapped, energy, weight, out)
    yield from _row_chunks(out, number)


def _multiply_part(flat, place, start, size, mapped, energy, weight, out) -> int:
    """Adds passages that begin with a half passage met in ``start:start + size``."""
    stop = min(len(flat), start + size)
    # Whole half passages: the part owns those that begin in it.
    low = start if start == 0 or place[start] != place[start - 1] else (
        np.searchsorted(place, place[start], side="right")
    )
    if low >= stop:
        return 0
    high = np.searchsorted(place, place[stop - 1], side="right")
    reach = np.searchsorted(place, place[high - 1] + 1, side="right")
    spot, term = place[low:reach], flat[low:reach]
    own, begin = np.unique(spot, return_index=True)
    counts = np.diff(np.append(begin, len(spot)))
    sums = segment_sums(mapped, term, begin, counts)
    weighed = np.add.reduceat(energy[term], begin)
    mine = own <= place[high - 1]
    follows = np.zeros(len(own), bool)
    follows[:-1] = own[1:] == own[:-1] + 1
    rows, power = sums.copy(), weighed.copy()
    pair = np.flatnonzero(follows)
    rows[pair] += sums[pair + 1]
    power[pair] += weighed[pair + 1]
    rows /= np.maximum(power, 1e-12)[:, None]
    rows[~mine] = 0
    back = rows.copy()
    back[pair + 1] += rows[pair]
    order = np.argsort(term, kind="stable")
    used, at = np.unique(term[order], return_index=True)
    added = np.add.reduceat(back[segments(counts)[order]], at)
    out[used] += weight[used][:, None].astype(np.float32) * added
    return int(mine.sum())


def _row_chunks(matrix: np.ndarray, number: int) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(matrix), ROW_CHUNK):
        part = matrix[first : first + ROW_CHUNK]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([first // ROW_CHUNK], pa.int32()),
                pa.array([number], pa.int64()),
                pa.array([part.tobytes()], pa.binary()),
            ],
            ["chunk", "passages", "part"],
        )


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    number: dict[int, int] = {}
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for chunk, passages, raw in rows:
            part = np.frombuffer(raw, np.float32).astype(np.float64)
            total[chunk] = total[chunk] + part if chunk in total else part
            number[chunk] = number.get(chunk, 0) + passages
    for chunk, part in total.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int32()),
                pa.array([number[chunk]], pa.int64()),
                pa.array([part.astype(np.float32).tobytes()], pa.binary()),
            ],
            ["chunk", "passages", "part"],
        )


_CHUNK_TYPE = "chunk int, passages long, part binary"


def _pass(
    index: DataFrame, chosen: np.ndarray, weight: np.ndarray, basis: np.ndarray
) -> tuple[np.ndarray, int]:
    """A'A·basis over all passages, added up in tasks, and the number of passages."""
    given = index.sparkSession.sparkContext.broadcast((chosen, weight, basis))  # bounded by the block
    shares = index.mapInArrow(lambda batches: _multiply(batches, *given.value), _CHUNK_TYPE)
    parts = -(-len(basis) // ROW_CHUNK)
    # First within groups of tasks, then over all, so no task adds up every share.
    salted = shares.repartition(8 * parts, "chunk", F.spark_partition_id() % 8)
    added = salted.mapInArrow(_add_chunks, _CHUNK_TYPE)
    summed = added.repartition(parts, "chunk").mapInArrow(_add_chunks, _CHUNK_TYPE)
    out, number = np.zeros(basis.shape), 0
    for row in summed.collect():  # terms x rank numbers
        part = np.frombuffer(row["part"], np.float32).reshape(-1, basis.shape[1])
        first = row["chunk"] * ROW_CHUNK
        out[first : first + len(part)] = part
        number = row["passages"]
    given.unpersist()
    return out, number


def _leading(basis: np.ndarray, moved: np.ndarray, rank: int) -> np.ndarray:
    """Leading directions of the matrix that took ``basis`` to ``moved``, after one pass.

    The Nyström form of the randomised SVD, shifted a little to stay stable.
    """
    shift = 1e-9 * np.linalg.norm(moved)
    moved = moved + shift * basis
    core = basis.T @ moved
    root = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(len(core)))
    left, _, _ = np.linalg.svd(np.linalg.solve(root, moved.T).T, full_matrices=False)
    return left[:, :rank]


def least_terms(block: Block, chosen: np.ndarray) -> np.ndarray:
    """Two, or one where no passage of the item has more than one index term."""
    own = np.array([np.isin(terms, chosen).sum() for terms in block.passage_terms])
    most = np.zeros(len(block.items), np.int64)
    np.maximum.at(most, block.passage_item, own)
    return np.minimum(2, most)[block.passage_item]


def latent_space(docs: DataFrame, block: Block, seed: int = 3) -> Space | None:
    """Randomised SVD of the corpus's and the block's passages."""
    if len(block.vocabulary) == 0:
        return None
    index = index_of(docs, block)
    seen, total = frequencies(index, len(block.vocabulary))
    chosen = choose_terms(block, seen, total)
    weight = np.log((2.0 + total) / (1.0 + seen[chosen]))
    number = len(block.passage_terms)
    position = np.full(len(block.vocabulary), -1)
    position[chosen] = np.arange(len(chosen))
    items = np.zeros((number, len(chosen)))
    for i, found in enumerate(block.passage_terms):
        own = position[found]
        own = own[own >= 0]
        items[i, own] = weight[own]
    items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12)
    width = min(len(chosen), RANK + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(chosen), width)))[0]
    moved, passages = _pass(index, position, weight, basis)
    # Passages have length 1, so their number is the corpus's energy.
    lead = ITEM_ENERGY * max(passages, 1) / number
    basis = _leading(basis, moved + lead * (items.T @ (items @ basis)), RANK)
    project = (weight[:, None] * basis).astype(np.float32)
    targets = items @ basis
    targets /= np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-12)
    targets = targets.T.astype(np.float32)
    return Space(block, block.vocabulary[chosen], project, targets, least_terms(block, chosen))


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one integer operation per word."""
    masks: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for word in text.tolist():
        mask = masks.get(word)
        if mask:
            met = row & mask
            row = (row + met | row - met) & full
    return len(item) - row.bit_count()


def _bound(counts: Counter, text: np.ndarray) -> int:
    """No common subsequence is longer."""
    here = Counter(w for w in text.tolist() if w in counts)
    return sum(min(n, counts[w]) for w, n in here.items())


def _holds(answer: np.ndarray, text: np.ndarray) -> bool:
    """The answer's words stand in the text in a row."""
    if len(answer) == 0 or len(answer) > len(text):
        return False
    for at in np.flatnonzero(text[: len(text) - len(answer) + 1] == answer[0]):
        if (text[at : at + len(answer)] == answer).all():
            return True
    return False


def _judge(block: Block, counters: list[Counter], item: int, text: np.ndarray):
    """(coverage, answer found) if the item is in the text, else None."""
    own = block.items[item]
    if _bound(counters[item], text) < PARAPHRASE * len(own):
        return None
    coverage = common_subsequence(own, text) / len(own)
    answer = _holds(block.answers[item], text)
    return (coverage, answer) if coverage >= COPY or coverage >= PARAPHRASE and answer else None


def _search(column: pa.Array, space: Space, counters: list[Counter]) -> pa.Array:
    found = words.words_of(column)
    half, term, halves = _term_hits(found, space.terms)
    hits: list[dict[int, tuple]] = [{} for _ in range(len(column))]
    first = np.cumsum(halves) - halves
    begin = np.cumsum(found.counts) - found.counts
    if len(half):
        own, at = np.unique(half, return_index=True)
        met = np.diff(np.append(at, len(half)))
        sums = segment_sums(space.project, term, at, met)
        for a in range(0, len(own), 4096):
            _search_part(column, space, counters, found, halves, first, begin, own, sums, met, a, hits)
    item = pa.struct(
        [
            ("item_id", pa.int64()),
            ("cosine", pa.float64()),
            ("coverage", pa.float64()),
            ("answer", pa.bool_()),
        ]
    )
    rows = [
        [
            {"item_id": space.block.ids[i], "cosine": h[0], "coverage": h[1], "answer": h[2]}
            for i, h in sorted(mine.items())
        ]
        for mine in hits
    ]
    return pa.array(rows, pa.list_(item))


def _search_part(column, space, counters, found, halves, first, begin, own, sums, met, a, hits):
    """Passages that begin with the half passages ``own[a:a + 4096]``."""
    stop = min(len(own), a + 4096)
    rows, number = sums[a:stop].copy(), met[a:stop].copy()
    owner = np.searchsorted(np.cumsum(halves), own, side="right")
    follows = np.zeros(stop - a, bool)
    limit = min(stop, len(own) - 1)
    follows[: limit - a] = (own[a + 1 : limit + 1] == own[a:limit] + 1) & (
        owner[a + 1 : limit + 1] == owner[a:limit]
    )
    pair = np.flatnonzero(follows)
    rows[pair] += sums[a + pair + 1]
    number[pair] += met[a + pair + 1]
    # A passage's two halves may lie the other way round: the one before had no term.
    length = np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    cosine = (rows @ space.targets) / length
    for row, passage in zip(*np.nonzero(cosine >= COSINE), strict=True):
        if number[row] < space.least[passage]:
            continue
        doc, item = owner[a + row], int(space.block.passage_item[passage])
        known = hits[doc].get(item)
        if known and known[1] >= 1.0:
            continue
        own_words = len(space.block.items[item])
        beyond = max(0, own_words - HALF)
        local = (own[a + row] - first[doc]) * HALF
        low = max(0, local - max(beyond, HALF))
        high = min(found.counts[doc], local + 2 * HALF + beyond)
        text = found.hashes[begin[doc] + low : begin[doc] + high]
        verdict = _judge(space.block, counters, item, text)
        if verdict and (known is None or verdict[0] > known[1]):
            hits[doc][item] = (round(float(cosine[row, passage]), 6), *verdict)


def _matcher(space: Space, text: Column) -> Column:
    given = broadcast_space(space)

    def load():
        known = given.value
        return known, [Counter(item.tolist()) for item in known.block.items]

    return text_udf(lambda part, state: _search(part, *state), HIT_TYPE, load)(text)


def broadcast_space(space: Space):
    return SparkSession.getActiveSession().sparkContext.broadcast(space)  # bounded by the block


def leaks(docs: DataFrame, benchmark: DataFrame) -> Column:
    """A column over ``docs``: the benchmark items in its text, as an array of structs."""
    found = []
    for block in blocks_of(benchmark):
        space = latent_space(docs, block)
        if space is not None:
            found.append(_matcher(space, F.col("text")))
    return F.concat(*found) if found else F.expr(f"cast(array() as {HIT_TYPE})")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows doc_id, item_id, cosine, coverage, answer: one per document and item in it."""
    hits = docs.select("doc_id", leaks(docs, benchmark).alias("hits"))
    return hits.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark item."""
    hits = leaks(docs, benchmark)
    marked = docs.select(F.struct(*docs.columns).alias("row"), hits.alias("hits"))
    return marked.where(F.size("hits") == 0).select("row.*")
