"""Words and shingles of many texts at once, as 64-bit hashes.

A word is a run of ASCII letters, digits and bytes of non-ASCII characters, in
lower case. All steps are array operations over the UTF-8 bytes of a slice of
the column, so the cost is some nanoseconds a byte and no word becomes a Python
object.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewatch.llm.common import bytes_of, segments

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values: equal in, equal out; near in, far out."""
    x = values ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E6C63D0876A9A47)
    return x ^ (x >> np.uint64(32))


def _power(base: np.uint64, size: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:size]


@dataclass
class Words:
    """Word ``i`` is bytes ``starts[i]:ends[i]`` of ``data``; ``counts`` has words per text."""

    data: np.ndarray
    borders: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray


def words_of(column: pa.Array) -> Words:
    data, borders = bytes_of(pc.utf8_lower(column))
    if len(data) == 0:
        none = np.empty(0, np.int64)
        counts = np.zeros(len(column), np.int64)
        return Words(data, borders, none, none, counts, np.empty(0, np.uint64))
    inside = _IS_WORD[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    first = borders[:-1][borders[:-1] < borders[1:]]
    opens[first] = inside[first]  # texts follow each other without a gap
    last = borders[1:][borders[:-1] < borders[1:]] - 1
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    counts = np.diff(np.searchsorted(starts, borders))
    return Words(data, borders, starts, ends, counts, hashes_of(data, starts, ends))


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch ``starts[i]:ends[i]`` of the bytes."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    weighted = (data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))
    np.cumsum(weighted, out=sums[1:])
    # A polynomial over the word's bytes, moved to begin at power 0.
    return mix((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(data))[starts])


def pieces_of(words: Words, longest: int, size: int, step: int) -> Words:
    """Each word of more than ``longest`` bytes as overlapping pieces, which are words of their own.

    A piece begins at every ``step`` bytes; together they hold all bytes of the word, and
    whatever is no longer than ``size - step`` stands whole in one of them.
    """
    length = words.ends - words.starts
    if length.max(initial=0) <= longest:
        return words
    long = length > longest
    number = np.where(long, 1 + -(-np.maximum(length - size, 0) // step), 1)
    owner = segments(number)
    place = np.arange(len(owner)) - (np.cumsum(number) - number)[owner]
    starts = words.starts[owner] + place * step
    ends = np.where(long[owner], np.minimum(starts + size, words.ends[owner]), words.ends[owner])
    text = segments(words.counts)
    counts = np.bincount(text[owner], minlength=len(words.counts))
    return Words(words.data, words.borders, starts, ends, counts, hashes_of(words.data, starts, ends))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row and their number per text, in text order.

    A text of fewer words is one shingle; a text without words has none.
    """
    counts, hashes = words.counts, words.hashes
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = segments(number)
    if len(owner) == 0:
        return np.empty(0, np.uint64), number
    place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + begin[owner]
    left = counts[owner] - (place - begin[owner])
    total = np.zeros(len(owner), np.uint64)
    for k in range(size):
        used = k < left
        value = mix(hashes[np.minimum(place + k, len(hashes) - 1)], k + 1)
        total += np.where(used, value, np.uint64(0))
    return mix(total), number


def distinct_per_text(values: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values once, in ascending order, and their number."""
    owner = segments(number)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.bincount(owner[keep], minlength=len(number))
