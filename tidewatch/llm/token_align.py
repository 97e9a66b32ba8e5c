"""Align the tokens of two tokenizers by the bytes at which both end.

Each text is encoded by both. Where an A token and a B token end at the same byte,
a group ends. The shorter list of ends drives: each of its ends is looked up in the longer
one, by steps that double from the place of the end before (galloping) and a binary search in
the last step. The rank found tells both things that are asked: an end that is met is a common
border, and the difference of ranks of one token's ends is the range of tokens that
overlap it, its links. ``LANE`` ends are galloped one after the other, all lanes of a batch
at once; the lanes' own first ends are galloped in the same way, a level higher.

A text is cut before each space that follows no white space and does not end it: there neither
tokenizer has a token across (A's pattern never takes a blank behind another character, and no
piece of B has one there, which is looked up), so each unit between cuts, mostly a word, is
encoded and aligned by itself, once per block of documents. A document is the sum of its units.

How often an id pair is linked in the corpus is counted in two steps. A block of
documents holds its distinct units, their distinct pairs and the pairs' numbers, so what is
shuffled grows with those, not with links. The totals go back to the blocks, each unit looks its
pairs up in its block's list, and each document its units. The largest total per B id has one
row per B token, so it may be broadcast at any size of the corpus.

A task holds one block: documents of up to ``BLOCK`` characters or ``UNITS`` distinct units,
and the document that goes beyond that.

Texts that are null or empty, and texts of which one tokenizer's bytes differ from
space + text, have no tokens: numbers 0, digest ''. Rows equal in all columns are rows of their
own. Other columns than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import list_array, rest, segments

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
#: A block is full at so many characters, or so many distinct units.
BLOCK, UNITS = 1 << 24, 1 << 18
#: Characters of units that are aligned together.
BATCH = 1 << 18
LANE = 32
GROUPS = "array<struct<start:long,end:long,a:array<int>,b:array<int>>>"
COUNTED = ("n_a", "n_b", "n_groups", "n_links")
_CUT = re.compile(r"(?<=[^\s\u180e]) (?!\Z)")


# --- the two vocabularies ---------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable bytes stand for themselves; the others follow from character 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Tokenizers:
    """Both encoders, and the bytes of each token."""

    def __init__(self, a: bytes, b: bytes):
        # Spark runs as many tasks as there are cores; each encodes in its own thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[number] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.b = SentencePieceProcessor(model_proto=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [_piece_bytes(piece) for piece in pieces]
        self.can_cut = not any(re.search("[^▁]▁", piece) for piece in pieces)
        self.a_width = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_width = np.array([len(t) for t in self.b_bytes], np.int64)

    def units(self, text: str) -> list[str]:
        """The text cut into units; the space before each but the first is left out."""
        return _CUT.split(text) if self.can_cut else [text]

    def encode(self, units: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """The ids of each unit under A and B; None where the bytes are not those of the unit."""
        whole = [" " + unit for unit in units]
        coded = self.a.encode_batch_fast(whole, add_special_tokens=False)
        pieces = self.b.encode(units, num_threads=1)
        found = []
        for unit, encoding, b in zip(whole, coded, pieces, strict=True):
            a, wanted = encoding.ids, unit.encode()
            same = (
                b"".join(map(self.a_bytes.__getitem__, a)) == wanted
                and b"".join(map(self.b_bytes.__getitem__, b)) == wanted
            )
            found.append((a, b) if same else None)
        return found


# --- galloping --------------------------------------------------------------


def gallop(longer: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many elements of ``longer`` are below each wanted value, searched from ``start`` on.

    ``longer`` ascends, and its last element is not below any wanted value.
    """
    low, high = start.copy(), start.copy()
    step = np.ones(len(start), np.int64)
    behind = np.flatnonzero(longer[high] < wanted)
    while len(behind):
        low[behind] = high[behind] + 1
        high[behind] = np.minimum(high[behind] + step[behind], len(longer) - 1)
        step[behind] *= 2
        behind = behind[longer[high[behind]] < wanted[behind]]
    wide = np.flatnonzero(low < high)
    while len(wide):
        middle = (low[wide] + high[wide]) >> 1
        less = longer[middle] < wanted[wide]
        low[wide[less]] = middle[less] + 1
        high[wide[~less]] = middle[~less]
        wide = wide[low[wide] < high[wide]]
    return low


def ranks(driver: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """``gallop`` for a whole ascending list, each search from where the one before ended."""
    found = np.zeros(len(driver), np.int64)
    if len(driver) <= LANE:
        at = np.zeros(1, np.int64)
        for i in range(len(driver)):
            at = gallop(longer, driver[i : i + 1], at)
            found[i] = at[0]
        return found
    found[::LANE] = at = ranks(driver[::LANE], longer)
    for step in range(1, LANE):
        wanted = driver[step::LANE]
        found[step::LANE] = at = gallop(longer, wanted, at[: len(wanted)])
    return found


@dataclass
class Alignment:
    """Many units aligned together. Unit ``i`` has ``n_a[i]`` A tokens, and so on.

    ``link_a`` and ``link_b`` are the ids of each link; ``group_a`` and ``group_b`` number
    the group of each token from 0 over all units.
    """

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def align(coded: list[tuple[list[int], list[int]]], a_width: np.ndarray, b_width: np.ndarray) -> Alignment:
    """Groups and links of units that each have tokens of equal bytes under A and B."""
    a = np.fromiter(chain.from_iterable(ids for ids, _ in coded), np.int64)
    b = np.fromiter(chain.from_iterable(ids for _, ids in coded), np.int64)
    n_a = np.array([len(ids) for ids, _ in coded], np.int64)
    n_b = np.array([len(ids) for _, ids in coded], np.int64)
    unit_a, unit_b = segments(n_a), segments(n_b)
    # Units follow each other without a gap, so ends ascend over all of them.
    end_a, end_b = np.cumsum(a_width[a]), np.cumsum(b_width[b])
    a_drives = n_a <= n_b
    drives_a, drives_b = a_drives[unit_a], ~a_drives[unit_b]

    # In unit order: the shorter list of each unit, and the longer one.
    def merged(of_a: np.ndarray, of_b: np.ndarray, pick_a: np.ndarray, pick_b: np.ndarray):
        unit = np.concatenate([unit_a[pick_a], unit_b[pick_b]])
        order = np.argsort(unit, kind="stable")
        return np.concatenate([of_a[pick_a], of_b[pick_b]])[order], unit[order]

    driver, unit = merged(end_a, end_b, drives_a, drives_b)
    longer, _ = merged(end_a, end_b, ~drives_a, ~drives_b)
    driver_id, _ = merged(a, b, drives_a, drives_b)
    longer_id, _ = merged(a, b, ~drives_a, ~drives_b)
    rank = ranks(driver, longer)
    met = longer[rank] == driver if len(rank) else np.zeros(0, bool)
    first = np.concatenate([[0], rank + met])[:-1]  # of the longer list's tokens it overlaps
    overlaps = rank - first + 1
    of_driver = segments(overlaps)
    of_longer = np.arange(len(of_driver)) - (np.cumsum(overlaps) - overlaps)[of_driver] + first[of_driver]
    left, right = driver_id[of_driver], longer_id[of_longer]
    a_first = a_drives[unit[of_driver]]
    number = len(n_a)
    border = driver[met]  # the ends of groups
    return Alignment(
        a=a,
        b=b,
        n_a=n_a,
        n_b=n_b,
        n_groups=np.bincount(unit[met], minlength=number),
        n_links=np.bincount(unit, overlaps, minlength=number).astype(np.int64),
        link_a=np.where(a_first, left, right),
        link_b=np.where(a_first, right, left),
        group_a=np.cumsum(np.isin(end_a, border)) - np.isin(end_a, border),
        group_b=np.cumsum(np.isin(end_b, border)) - np.isin(end_b, border),
    )


class GroupText:
    """The text form of groups, ``a1,a2|b1;a3|b2,b3``, for many units at once."""

    def __init__(self, a_size: int, b_size: int):
        self.a = [np.array([f"{i}{c}" for i in range(a_size)], object) for c in ",|"]
        self.b = [np.array([f"{i}{c}" for i in range(b_size)], object) for c in ",;"]

    def of(self, found: Alignment) -> list[str]:
        """One text per unit, with ``;`` behind each group."""
        if len(found.a) == 0:
            return [""] * len(found.n_a)
        groups = int(found.group_a[-1]) + 1
        a_through = np.cumsum(np.bincount(found.group_a, minlength=groups))
        b_through = np.cumsum(np.bincount(found.group_b, minlength=groups))
        b_before = np.concatenate([[0], b_through[:-1]])
        last_a = np.diff(found.group_a, append=groups) > 0
        last_b = np.diff(found.group_b, append=groups) > 0
        text = np.empty(len(found.a) + len(found.b), object)
        at_a = np.arange(len(found.a)) + b_before[found.group_a]
        at_b = np.arange(len(found.b)) + a_through[found.group_b]
        text[at_a] = np.where(last_a, self.a[1][found.a], self.a[0][found.a])
        text[at_b] = np.where(last_b, self.b[1][found.b], self.b[0][found.b])
        ends = np.cumsum(found.n_a + found.n_b)
        return ["".join(text[e - n : e]) for e, n in zip(ends, found.n_a + found.n_b, strict=True)]


# --- documents --------------------------------------------------------------


class _Units:
    """The distinct units of a block, numbered as they come in."""

    def __init__(self, known: Tokenizers, shown: GroupText):
        self.known, self.shown = known, shown
        self.number: dict[str, int] = {}
        self.counts, self.texts, self.whole, self.codes = [], [], [], []
        self.waiting, self.size = [], 0

    def of(self, text: str) -> np.ndarray:
        """The numbers of a text's units in order."""
        number = self.number
        units = self.known.units(text)
        found = list(map(number.get, units))
        if None in found:
            for i, unit in enumerate(units):
                if found[i] is None:
                    at = number.get(unit)
                    found[i] = len(number) if at is None else at
                    if at is None:
                        number[unit] = found[i]
                        self.waiting.append(unit)
                        self.size += len(unit)
            if self.size >= BATCH:
                self.align()
        return np.array(found, np.int32)

    def align(self) -> None:
        """Encode and align the units that have come in since."""
        coded = self.known.encode(self.waiting)
        whole = np.array([c is not None for c in coded], bool)
        found = align([c or ([], []) for c in coded], self.known.a_width, self.known.b_width)
        self.whole.append(whole)
        self.counts.append(np.stack([getattr(found, name) for name in COUNTED], axis=1))
        self.codes.append(found.link_a * len(self.known.b_width) + found.link_b)
        self.texts += [text[:-1] for text in self.shown.of(found)]
        self.waiting, self.size = [], 0

    def __len__(self) -> int:
        return len(self.number)


def _read_files(spark: SparkSession, a: str, b: str) -> Callable[[], Tokenizers]:
    files = []
    for path in (a, b):
        with open(path, "rb") as file:
            files.append(spark.sparkContext.broadcast(file.read()))  # some MB each
    return lambda: Tokenizers(*[file.value for file in files])


def _block(ids: list, documents: list[np.ndarray], units: _Units, schema: pa.Schema, number: int) -> pa.RecordBatch:
    """One row per document, with its distinct units, and a row with the block's lists."""
    units.align()
    counts, whole = np.concatenate(units.counts), np.concatenate(units.whole)
    codes, links = np.concatenate(units.codes), counts[:, COUNTED.index("n_links")]
    results, held, times = [], [], []
    used = np.zeros(len(units), np.int64)
    for found in documents:
        if len(found) == 0 or not whole[found].all():
            results.append((*[0] * len(COUNTED), ""))
            found = found[:0]
        else:
            text = ";".join([units.texts[i] for i in found.tolist()])
            digest = hashlib.sha256(text.encode()).hexdigest()
            results.append((*counts[found].sum(axis=0).tolist(), digest))
        distinct, repeats = np.unique(found, return_counts=True)
        held.append(distinct)
        times.append(repeats)
        used[distinct] += repeats
    pairs, place = np.unique(codes, return_inverse=True)
    totals = np.zeros(len(pairs), np.int64)
    np.add.at(totals, place, used[segments(links)])
    sizes = np.array([len(h) for h in held], np.int64)
    rows = len(documents)
    numbers = list(zip(*results, strict=True))

    def last_row(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return list_array(values, np.append(np.zeros(rows, np.int64), len(values)), kind)

    columns = [
        pa.array([*ids, None], schema.field("doc_id").type),
        *[pa.array([*c, 0], pa.int64()) for c in numbers[:-1]],
        pa.array([*numbers[-1], ""], pa.string()),
        pa.array([number] * (rows + 1), pa.int64()),
        pa.array([False] * rows + [True]),
        list_array(np.concatenate(held).astype(np.int32), np.append(sizes, 0), pa.int32()),
        list_array(np.concatenate(times).astype(np.int32), np.append(sizes, 0), pa.int32()),
        last_row(pairs, pa.int64()),
        last_row(totals, pa.int64()),
        last_row(links.astype(np.int32), pa.int32()),
        last_row(place.astype(np.int32), pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _blocks(load: Callable[[], Tokenizers]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        shown = GroupText(len(known.a_width), len(known.b_width))
        partition, number = TaskContext.get().partitionId(), 0
        ids, documents, size, units, schema = [], [], 0, _Units(known, shown), None
        for batch in batches:
            schema = pa.schema(
                [
                    ("doc_id", batch.schema.field("doc_id").type),
                    *[(name, pa.int64()) for name in COUNTED],
                    ("groups_sha256", pa.string()),
                    ("block", pa.int64()),
                    ("is_list", pa.bool_()),
                    ("units", pa.list_(pa.int32())),
                    ("times", pa.list_(pa.int32())),
                    ("codes", pa.list_(pa.int64())),
                    ("totals", pa.list_(pa.int64())),
                    ("links", pa.list_(pa.int32())),
                    ("places", pa.list_(pa.int32())),
                ]
            )
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                ids.append(doc_id)
                documents.append(units.of(text) if text else np.empty(0, np.int32))
                size += len(text)
                if size >= BLOCK or len(units) >= UNITS:
                    yield _block(ids, documents, units, schema, (partition << 32) + number)
                    ids, documents, size, units = [], [], 0, _Units(known, shown)
                    number += 1
        if documents:
            yield _block(ids, documents, units, schema, (partition << 32) + number)

    return run


def _look_up(rows: pa.Table, listed: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    size = listed.num_rows
    values = np.zeros((2, size), np.int64)
    values[:, listed.column("place").to_numpy()] = [listed.column(c).to_numpy() for c in ("is_best", "total")]
    flat = lambda table, name: table.column(name).combine_chunks().flatten().to_numpy()
    is_list = rows.column("is_list")
    lists, docs = rows.filter(is_list), rows.filter(pc.invert(is_list))
    links, places = flat(lists, "links"), flat(lists, "places")
    held = docs.column("units").combine_chunks()
    owner = segments(held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    units, times = flat(docs, "units"), flat(docs, "times").astype(np.int64)
    kept = docs.select(["doc_id", *COUNTED])
    for name, value in zip(("n_best", "count_sum"), values, strict=True):
        # Whole numbers all the way: sums stay exact beyond 2^53.
        of_unit, of_document = np.zeros(len(links), np.int64), np.zeros(docs.num_rows, np.int64)
        np.add.at(of_unit, segments(links), value[places])
        np.add.at(of_document, owner, times * of_unit[units])
        kept = kept.append_column(name, pa.array(of_document))
    return kept.append_column("groups_sha256", docs.column("groups_sha256"))


def compare(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """Rows: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose pair is the most frequent, or one of them, of its B id in the
    corpus. ``count_sum``: the sum over links of how often their pair is linked in the corpus.
    """
    load = _read_files(docs.sparkSession, a, b)
    b_size = len(load().b_width)
    key = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    numbers = [T.StructField(name, T.LongType()) for name in COUNTED]
    digest = T.StructField("groups_sha256", T.StringType())
    lists = "block long, is_list boolean, units array<int>, times array<int>, codes array<long>, totals array<long>, links array<int>, places array<int>"
    schema = T.StructType([key, *numbers, digest, *T.StructType.fromDDL(lists).fields])
    texts = docs.select("doc_id", "text")
    aligned = rest(texts.mapInArrow(_blocks(load), schema), "token_align")

    in_block = F.posexplode(F.arrays_zip("codes", "totals"))
    listed = aligned.where("is_list").select("block", in_block).select(
        "block", F.col("pos").alias("place"), F.col("col.codes").alias("code"), F.col("col.totals").alias("n")
    )
    totals = listed.groupBy("code").agg(F.sum("n").alias("total"))
    b_id = (F.col("code") % b_size).alias("b_id")
    best = totals.groupBy(b_id).agg(F.max("total").alias("most"))
    judged = totals.withColumn("b_id", b_id).join(F.broadcast(best), "b_id")
    looked_up = listed.join(
        judged.select("code", "total", (F.col("total") == F.col("most")).cast("long").alias("is_best")), "code"
    ).select(F.col("block").alias("list_of"), "place", "total", "is_best")

    sums = [T.StructField(name, T.LongType()) for name in ("n_best", "count_sum")]
    result = T.StructType([key, *numbers, *sums, digest])
    rows = aligned.drop("codes", "totals")
    return rows.groupBy("block").cogroup(looked_up.groupBy("list_of")).applyInArrow(_look_up, result)


def groups(
    spark: SparkSession, text: Column, a: str = TOKENIZER_A, b: str = TOKENIZER_B
) -> Column:
    """An array of structs start, end, a, b: each group's bytes in space + text, and its ids."""
    load = _read_files(spark, a, b)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = load()
        kind = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
        )
        for column in columns:
            yield pa.array([_groups_of(t, known) for t in column.to_pylist()], kind)

    return F.arrow_udf(run, GROUPS)(text)


def _groups_of(text: str | None, known: Tokenizers) -> list[dict]:
    coded = known.encode(known.units(text)) if text else []
    if not coded or None in coded:
        return []
    found = align(coded, known.a_width, known.b_width)
    number = int(found.n_groups.sum())
    ends = np.cumsum(np.bincount(found.group_a, known.a_width[found.a], number)).astype(np.int64)
    split = lambda ids, group: np.split(ids, np.searchsorted(group, np.arange(1, number)))
    sides = zip(split(found.a, found.group_a), split(found.b, found.group_b), strict=True)
    starts = [0, *ends[:-1].tolist()]
    return [
        {"start": s, "end": e, "a": x.tolist(), "b": y.tolist()}
        for s, e, (x, y) in zip(starts, ends.tolist(), sides, strict=True)
    ]
