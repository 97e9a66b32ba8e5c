"""Mine phrases by Toivonen's method: a sample proposes, full passes count exactly.

A phrase is a run of words within a piece of text, its frequency all its occurrences. No
phrase is more frequent than a part of it, so a phrase needs counting only if the two phrases
that are one word shorter are frequent, or may be.

1. A sample of documents, drawn by hash, is mined with a lowered limit.
2. A full pass counts every word, and each longer phrase whose two parts are frequent in the
   sample: the phrases that the sample proposes and their negative border. It counts by a hash of
   the phrase, as the border is many times the phrases that turn out to be frequent. A hash's
   count is never below that of its phrase, so none is missed.
3. Where a word or phrase that is frequent in the corpus was not so in the sample (the border
   fails), phrases with it as a part have not been counted. A second full pass counts the closure
   that this opens: each uncounted phrase whose parts are frequent, or themselves opened and so
   not known yet. With it the set is closed, as every part of an uncounted phrase is known
   to be infrequent. The same pass counts the phrases of frequent hashes by their text; the
   counts that are returned are all by text, and exact.

Sets of hashes travel as Bloom filters of fixed size, whatever the corpus. A phrase that a filter
takes for a member is counted in all documents or in none: a fuller filter costs time, never
results. A task counts in blocks of bounded size, and only a block's distinct phrases are
shuffled, summed before and after.

Null and empty texts have no words. A null language is ``und``, the same as that text. Rows
equal in all columns are rows of their own, and count each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import bytes_of, chunks, rest
from tidewatch.llm.words import hashes_of

#: Every how many documents one is in the sample, and the limit there as a share of the
#: count to be expected of a phrase that is just frequent.
SAMPLE_EVERY = 4
LOWERED = 0.8
#: Bits of the Bloom filter, and the bits that each phrase sets.
FILTER_BITS = 1 << 26
FILTER_HASHES = 3
#: Bytes of text that are counted together in a task.
BLOCK_BYTES = 1 << 21
#: Frequent words are parts of very many phrases: their rows are spread over as many keys.
SALTS = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: A text key is a language, a tab and a phrase: no word has a tab, so the last one parts them.
TEXT_COUNTS = "key string, n long"
#: A hash key is a phrase's hash, with its number of words in the lowest bits.
HASH_COUNTS = "key long, n long"
WORDS_MASK = 15


# --- words and phrases of a block -------------------------------------------


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of some texts in lower case, the text of each, and the words left in its piece.

    ``left`` counts the word itself: a phrase of k words begins where it is at least k.
    """
    data, borders = bytes_of(column)
    data = _LOWER[data]
    if len(data) == 0:
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int64)
    breaks = _BREAK[data]
    inside = ~(_BLANK[data] | breaks)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    full = borders[:-1] < borders[1:]  # texts follow each other without a gap
    opens[borders[:-1][full]] = inside[borders[:-1][full]]
    closes[borders[1:][full] - 1] = inside[borders[1:][full] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    text = np.searchsorted(borders, starts, side="right") - 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    words = pa.Array.from_buffers(pa.string(), len(starts), buffers)
    piece = np.cumsum(breaks, dtype=np.int32)[starts] if len(starts) else starts
    last = np.ones(len(starts), bool)  # of its piece
    last[:-1] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    closing = np.flatnonzero(last)
    left = closing[np.searchsorted(closing, np.arange(len(starts)))] - np.arange(len(starts)) + 1
    return words, text, left


def _mix(values: np.ndarray) -> np.ndarray:
    x = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _phrase_hash(first: np.ndarray, last_word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all its words but the last, and of the last."""
    return _mix(first * np.uint64(0x9E3779B97F4A7C15) + last_word)


def _tagged(hashes: np.ndarray, words: int) -> np.ndarray:
    return hashes & ~np.uint64(WORDS_MASK) | np.uint64(words)


class Filter:
    """A Bloom filter over hash keys: never says no to a member."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # uint64 words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in filter_places(hashes, len(self.bits) * 64):
            word, bit = place >> np.uint64(6), place & np.uint64(63)
            found &= (self.bits[word] >> bit & np.uint64(1)).astype(bool)
        return found


def filter_places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    step = _mix(hashes) | np.uint64(1)
    return [_mix(hashes + np.uint64(k) * step) % np.uint64(size) for k in range(FILTER_HASHES)]


class Block:
    """The words of some texts, and their phrases of growing length."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        self.words, self.text, self.left = words_of(texts)
        self.names = sorted(set(langs))
        self.lang_of = np.array([self.names.index(lang) for lang in langs], np.int64)
        coded = self.words.dictionary_encode()
        spelled = coded.dictionary
        # A word of two languages is two words; so is every phrase of it.
        pairs = self.lang_of[self.text] * max(len(spelled), 1) + coded.indices.to_numpy()
        distinct, self.first, self.word, self.times = np.unique(
            pairs, return_index=True, return_inverse=True, return_counts=True
        )
        lang, number = np.divmod(distinct, max(len(spelled), 1))
        data, borders = bytes_of(spelled)
        spelling = hashes_of(data, borders[:-1], borders[1:]) if len(data) else np.empty(0, np.uint64)
        seeds = np.array([xxhash.xxh64_intdigest(name) for name in self.names], np.uint64)
        self.word_hash = _mix(spelling[number] ^ seeds[lang])

    def phrases(
        self, longest: int, now: Filter | None, before: Filter | None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Words, hash keys, first places, numbers, and which are opened, of distinct phrases.

        These are the words and each longer phrase whose parts are both in ``now`` (always, if
        that is None) or opened themselves. A phrase is opened if it is longer than a word, and
        its parts are not both in ``before``, or one is opened: then it has not been counted yet.
        A filter may take an opened part for a member, so being in ``before`` is not enough.
        """
        gram, hashes, number = self.word, self.word_hash, max(len(self.word_hash), 1)
        opened = np.zeros(len(hashes), bool)
        yield 1, _tagged(hashes, 1), self.first, self.times, opened
        # ``gram`` numbers the phrase at each place, -1 where none is looked at.
        for length in range(2, longest + 1):
            here = np.flatnonzero((self.left >= length) & (gram >= 0))
            here = here[gram[here + 1] >= 0] if len(here) else here
            keys = _tagged(hashes, length - 1)
            maybe = np.ones(len(keys), bool) if now is None else now.has(keys) | opened
            here = here[maybe[gram[here]] & maybe[gram[here + 1]]] if len(here) else here
            codes = gram[here] * number + self.word[here + length - 1]
            values, at, place, times = np.unique(
                codes, return_index=True, return_inverse=True, return_counts=True
            )
            first = here[at]
            old = np.ones(len(values), bool)
            if before is not None and len(first):
                counted = before.has(keys) & ~opened
                old = counted[gram[first]] & counted[gram[first + 1]]
            prefix, last = np.divmod(values, number)
            hashes, opened = _phrase_hash(hashes[prefix], self.word_hash[last]), ~old
            gram = np.full(len(gram), -1, np.int64)
            gram[here] = place
            yield length, _tagged(hashes, length), first, times, opened

    def hash_counts(self, longest: int, now: Filter | None) -> pa.RecordBatch:
        found = list(self.phrases(longest, now, None))
        keys = np.concatenate([f[1] for f in found]).view(np.int64)
        return pa.RecordBatch.from_arrays([keys, np.concatenate([f[3] for f in found])], ["key", "n"])

    def text_counts(self, longest: int, wanted: Filter, now: Filter, before: Filter) -> pa.RecordBatch:
        """The phrases in ``wanted`` and those opened; and, with an empty phrase, all a language's words."""
        leads = pa.array([name + "\t" for name in self.names], pa.string())
        texts, numbers = [leads], [np.bincount(self.lang_of[self.text], minlength=len(self.names))]
        for length, keys, at, times, opened in self.phrases(longest, now, before):
            kept = opened | wanted.has(keys)
            at = at[kept]
            spelt = [self.words.take(pa.array(at + k)) for k in range(length)]
            lead = leads.take(pa.array(self.lang_of[self.text[at]]))
            texts.append(pc.binary_join_element_wise(lead, pc.binary_join_element_wise(*spelt, " "), ""))
            numbers.append(times[kept])
        return pa.RecordBatch.from_arrays([pa.concat_arrays(texts), np.concatenate(numbers)], ["key", "n"])


# --- passes -----------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Texts and their languages, ``size`` bytes at a time; a longer text is alone."""
    held, langs, total = [], [], 0
    for batch in batches:
        texts, own = batch.column("text").fill_null(""), batch.column("lang").to_pylist()
        at = 0
        for part in chunks(texts, size):
            if held and total + part.nbytes > size:
                yield pa.concat_arrays(held), langs
                held, langs, total = [], [], 0
            held.append(part)
            langs += own[at : at + len(part)]
            at += len(part)
            total += part.nbytes
    if held:
        yield pa.concat_arrays(held), langs


def _counted(docs: DataFrame, schema: str, count: Callable) -> DataFrame:
    size = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_block = count()
        for texts, langs in _blocks(batches, size):
            yield of_block(Block(texts, langs))

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return texts.mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n"))


def hash_counted(docs: DataFrame, longest: int, now: Callable | None = None) -> DataFrame:
    """One pass by hash: key, n. The filter is given as what loads it in a task."""

    def count() -> Callable[[Block], pa.RecordBatch]:
        known = now() if now else None
        return lambda block: block.hash_counts(longest, known)

    return _counted(docs, HASH_COUNTS, count)


def text_counted(
    docs: DataFrame, longest: int, wanted: Callable, now: Callable, before: Callable
) -> DataFrame:
    """Phrases of ``wanted`` hashes, and those opened, by their text: lang, words, phrase, n.

    A row of 0 words has all word occurrences of its language.
    """

    def count() -> Callable[[Block], pa.RecordBatch]:
        filters = wanted(), now(), before()
        return lambda block: block.text_counts(longest, *filters)

    phrase = F.substring_index("key", "\t", -1)
    lang = F.expr("substring(key, 1, length(key) - locate('\t', reverse(key)))")
    words = F.when(F.endswith("key", F.lit("\t")), 0).otherwise(F.regexp_count(phrase, F.lit(" ")) + 1)
    return _counted(docs, TEXT_COUNTS, count).select(
        lang.alias("lang"), words.alias("words"), phrase.alias("phrase"), "n"
    )


def filter_of(keys: DataFrame, bits: int = FILTER_BITS) -> Callable[[], Filter]:
    """A filter with all hash keys, made on the cluster; its size is all that is collected."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(filter_places(batch.column("key").to_numpy().view(np.uint64), bits))
            word = (place >> np.uint64(6)).astype(np.int64)
            bit = np.left_shift(np.uint64(1), place & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([word, bit], ["word", "bits"])

    words = keys.select("key").mapInArrow(places, "word long, bits long")
    found = words.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    whole = np.zeros(bits // 64, np.uint64)
    whole[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    sent = keys.sparkSession.sparkContext.broadcast(whole)  # bits / 8 bytes
    return lambda: Filter(sent.value)


def _not_in(load: Callable[[], Filter]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(~known.has(keys)))

    return run


def in_sample(docs: DataFrame, every: int) -> DataFrame:
    """One of ``every`` documents, by a hash of text and language alone."""
    return docs.where(F.pmod(F.xxhash64("text", "lang"), F.lit(every)) == 0)


def frequent(
    docs: DataFrame,
    min_count: int = 10,
    longest: int = 3,
    sample_every: int = SAMPLE_EVERY,
    on_failed: Callable[[int], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with at least ``min_count`` occurrences, and sizes.

    Rows lang, words, phrase, n; and lang, n: the word occurrences of each language.
    ``on_failed`` is told at how many words and phrases the border failed.
    """
    if not 1 <= longest < WORDS_MASK:
        raise ValueError(f"phrases have 1 to {WORDS_MASK - 1} words")
    # Once in the sample is no sign of anything, unless all that is wanted is that rare.
    lowered = max(min(2, min_count), int(min_count / sample_every * LOWERED))
    is_part = F.col("key").bitwiseAND(F.lit(WORDS_MASK)) < longest  # of a longer phrase
    enough = F.col("n") >= min_count
    sample = hash_counted(in_sample(docs, sample_every), longest - 1)
    proposed = rest(sample.where(F.col("n") >= lowered).select("key"), "phrases_sample")
    before = filter_of(proposed)
    found = rest(hash_counted(docs, longest, before).where(enough), "phrases_found")
    # The border fails where a frequent phrase is not in the set that was counted with.
    failed = found.where(is_part).mapInArrow(_not_in(before), HASH_COUNTS).count()
    if on_failed:
        on_failed(failed)
    now = filter_of(found.where(is_part).select("key").unionByName(proposed)) if failed else before
    counts = text_counted(docs, longest, filter_of(found), now, before)
    counts = rest(counts.where((F.col("n") >= min_count) | (F.col("words") == 0)), "phrases_frequent")
    return counts.where("words > 0"), counts.where("words = 0 and n > 0").select("lang", "n")


# --- collocations -----------------------------------------------------------


def _words(first: Column, last: Column) -> Column:
    """Words ``first`` to ``last`` (from 1) of the phrase, joined by blanks."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def _parts_of(cuts: DataFrame, found: DataFrame) -> DataFrame:
    """The phrases in ``found`` that are a part of others: words mostly, as few phrases are in a longer one."""
    used = cuts.select(F.col("lang").alias("_lang"), F.explode(F.array("_left", "_right")).alias("_part")).distinct()
    return found.join(used, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left_semi")


def _with_counts(rows: DataFrame, part: str, found: DataFrame, name: str) -> DataFrame:
    """Add the count of the phrase in column ``part``, which is frequent as the whole is.

    The most frequent words are parts of many phrases: rows are spread over ``SALTS`` keys.
    """
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    known = found.select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(name), salts.alias("_salt")
    )
    match = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")) & (salt == F.col("_salt"))
    return rows.join(known, match).drop("_lang", "_part", "_salt")


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut: lang, phrase, words, a, l, r, score.

    score = floor(1000000 a a / (l r)), l and r the counts of the parts; in a tie the first
    cut. Exact with decimals of 38 digits, for counts below 10^16.
    """
    phrases = found.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns(
        {"_left": _words(F.lit(1), F.col("k")), "_right": _words(F.col("k") + 1, F.col("words"))}
    )
    parts = _parts_of(cuts, found)
    counted = _with_counts(_with_counts(cuts, "_left", parts, "l"), "_right", parts, "r")
    score = F.expr(
        "cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0))"
        " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    ).cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return counted.groupBy("lang", "words", "phrase", "a").agg(lowest).select(
        "lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def without_parts(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """Without those that stand in a longer one at least ``percent`` % as frequent.

    A longer one counts whether it is kept itself or not.
    """
    shorter = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_size")
    sized = phrases.where("words > 2").select("lang", "words", "phrase", "a", shorter)
    start = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_size") + 1)).alias("_start")
    placed = sized.select("*", start)
    part = _words(F.col("_start"), F.col("_start") + F.col("_size") - 1)
    parts = placed.groupBy(F.col("lang").alias("_lang"), part.alias("_part")).agg(F.max("a").alias("_most"))
    joined = phrases.join(
        parts, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left"
    )
    held = F.coalesce(F.col("_most") * 100 >= F.col("a") * percent, F.lit(False))
    return joined.where(~held).drop("_lang", "_part", "_most")


def best(phrases: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` of each language by score, a, and phrase; add ``rank``.

    First among those of one hash per language, so that no task sees all of a language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = phrases.withColumn("_salt", salt)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order)))
    some = some.where(F.col("rank") <= rows).drop("_salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= rows)


def mine(
    docs: DataFrame, min_count: int = 10, longest: int = 3, rows: int = 2000, percent: int = 50, **options
) -> DataFrame:
    """Rows lang, rank, phrase, a, l, r, n, score: the best collocations of each language."""
    found, sizes = frequent(docs, min_count, longest, **options)
    candidates = rest(scored(found), "phrases_scored")
    ranked = best(without_parts(candidates, percent), rows)
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    # One row per language: as many as there are, and Spark knows the size.
    return ranked.join(sizes.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang")).select(*columns)


def mine_sql(min_count: int = 10, longest: int = 3, rows: int = 2000, percent: int = 50) -> str:
    """The same by counting every phrase of ``documents``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    later = ["word", *[f"lead(word, {k}) OVER piece_order" for k in range(1, longest)]]
    leads = ", ".join(f"{column} AS w{k}" for k, column in enumerate(later))
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS words, concat_ws(' ', {', '.join(f'w{i}' for i in range(k))}) AS phrase FROM runs WHERE w{k - 1} IS NOT NULL"
        for k in range(1, longest + 1)
    )
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), lists AS (
        SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), placed AS (
        SELECT r, lang, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM lists
    ), runs AS (
        SELECT lang, {leads} FROM placed WINDOW piece_order AS (PARTITION BY r ORDER BY place)
    ), grams AS ({grams}),
    f AS (SELECT lang, words, phrase, count(*) AS a FROM grams GROUP BY ALL),
    sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= {min_count}),
    cuts AS (
        SELECT *, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
        FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)
    ), scores AS (
        SELECT c.lang, c.words, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
               ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
    ), lowest AS (
        SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), parts AS (
        SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS most
        FROM (SELECT *, unnest(range(1, words - s + 2)) AS i
              FROM (SELECT *, unnest(range(2, words)) AS s FROM candidates))
        GROUP BY ALL
    ), kept AS (
        SELECT lowest.* FROM lowest LEFT JOIN parts USING (lang, phrase)
        WHERE NOT coalesce(100 * most >= {percent} * a, false)
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
    ) AS ranked JOIN sizes USING (lang) WHERE rank <= {rows}"""
