"""Toxicity of whole texts by a bidirectional recurrent network over windows.

Words and their characters are the input (see ``bigru``); a run of letters longer than
a word is, as in scripts without spaces, is cut into overlapping pieces. A text is cut into
overlapping windows that cover it from end to end; each gets a logit, and the
text's score is that of its most toxic window. The network is trained in numpy on a
bounded sample of labelled documents: the loss is on the text's label, and its
gradient goes through the windows that decided. Every fourth sampled document is
kept out, to choose among the steps of training and to set the scale and the offset of the score.

A text without words has score 0; so has every text if there is no labelled row.
Nothing but the text enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words
from tidewatch.llm.bigru import CHAR_ROWS, WORD_DIM, WORD_ROWS, Adam, BiGru, Lexicon
from tidewatch.llm.common import chunks, segments, text_udf
from tidewatch.llm.sample import fold, labelled_sample

#: The bound of the training sample: documents per label, characters of each.
PER_LABEL, MAX_CHARS = 1_600, 12_000
WINDOW, STRIDE = 32, 24
#: A run of letters of more bytes (unspaced scripts, words run together) is read in pieces of a word's size.
LONGEST, PIECE, PIECE_STEP = 64, 24, 12
STEPS, BATCH, RATE = 240, 48, 0.01
CHECK_EVERY, CHECK = 24, 400
ORDERS = (3, 4)
#: Windows scored by one call of the network.
PART = 4096


@dataclass
class Model:
    net: BiGru
    scale: float
    offset: float


def lexicon_of(found: words.Words, at: np.ndarray) -> Lexicon:
    """The words at these places, with sequences of 3 and 4 bytes from ``<`` to ``>``."""
    length = found.ends[at] - found.starts[at] + 2
    owner = segments(length)
    place = np.arange(len(owner)) - (np.cumsum(length) - length)[owner]
    inner = np.clip(place - 1, 0, length[owner] - 3) + found.starts[at][owner]
    letter = np.where(place == 0, 60, np.where(place == length[owner] - 1, 62, found.data[inner]))
    letter = letter.astype(np.uint32)
    rows, owners = [], []
    for n in ORDERS:
        value = np.full(len(letter), n, np.uint32)
        for k in range(n):
            value = (value ^ np.roll(letter, -k)) * np.uint32(0x01000193)
        value ^= value >> np.uint32(13)
        value *= np.uint32(0x85EBCA6B)
        whole = place + n <= length[owner]
        rows.append((value[whole] >> np.uint32(18)).astype(np.int64) % CHAR_ROWS)
        owners.append(owner[whole])
    owners, rows = np.concatenate(owners), np.concatenate(rows)
    order = np.argsort(owners, kind="stable")
    word_rows = (found.hashes[at] >> np.uint64(40)).astype(np.int64) % WORD_ROWS
    return Lexicon(word_rows, rows[order], np.bincount(owners, minlength=len(at)))


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each window; they cover every word of every text."""
    number = np.where(counts > 0, 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE), 0)
    text = segments(number)
    place = np.arange(len(text)) - (np.cumsum(number) - number)[text]
    first = place * STRIDE
    begin = np.cumsum(counts) - counts
    return text, begin[text] + first, np.minimum(counts[text] - first, WINDOW)


def _prepare(column: pa.Array):
    """Distinct words or pieces, and windows as rows of places among them."""
    found = words.pieces_of(words.words_of(column), LONGEST, PIECE, PIECE_STEP)
    _, at, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
    text, first, size = windows_of(found.counts)
    steps = np.arange(WINDOW)
    mask = (steps < size[:, None]).astype(np.float32)
    spot = np.minimum(first[:, None] + steps, max(0, len(inverse) - 1))
    index = inverse[spot] if len(inverse) else spot
    return lexicon_of(found, at) if len(at) else None, text, index, mask


def _logits(net: BiGru, column: pa.Array) -> np.ndarray:
    """The largest window logit of each text; -inf without words."""
    out = np.full(len(column), -np.inf)
    lexicon, text, index, mask = _prepare(column)
    if lexicon is None:
        return out
    x = net.inputs(lexicon)
    for a in range(0, len(text), PART):
        found, _ = net.forward(x, index[a : a + PART], mask[a : a + PART])
        np.maximum.at(out, text[a : a + PART], found)
    return out


def train(sample: pa.Table, toxic_share: float, seed: int = 6) -> Model | None:
    """Fit on ``text, label``; None if either label is missing.

    The sample has both labels in like numbers; ``toxic_share`` is that of the table, for which
    scores are calibrated.
    """
    label = np.array(sample["label"].to_pylist(), np.int64)
    if len(set(label.tolist())) < 2:
        return None
    texts = sample["text"].combine_chunks()
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(label))
    kept_out, used = order[: len(label) // 4], order[len(label) // 4 :]
    if len(set(label[used].tolist())) < 2:
        kept_out, used = order, order
    kept_out = kept_out[:CHECK]
    check, check_label = texts.take(pa.array(kept_out)), label[kept_out]
    pools = [used[label[used] == k] for k in (0, 1)]
    net, adam = BiGru.fresh(seed), Adam(RATE)
    best, best_loss = None, np.inf
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(p, BATCH // 2) for p in pools])
        column = texts.take(pa.array(rows))
        lexicon, text, index, mask = _prepare(column)
        if lexicon is None:
            continue
        x = net.inputs(lexicon)
        logits, _ = net.forward(x, index, mask)
        # The deciding window of each text, and one more at random to look around.
        top = np.lexsort((-logits, text))
        lead = top[np.unique(text[top], return_index=True)[1]]
        target = label[rows][text[lead]]
        negative = np.flatnonzero(label[rows][text] == 0)
        other = rng.choice(negative, min(len(negative), BATCH)) if len(negative) else negative
        chosen = np.concatenate([lead, other])
        goal = np.concatenate([target, np.zeros(len(other))])
        used_words, spots = np.unique(index[chosen], return_inverse=True)
        spots, few = spots.reshape(-1, WINDOW), lexicon.only(used_words)
        x = net.inputs(few)
        # Half of the words are read by their characters alone.
        hidden = rng.random(len(x)) < 0.5
        x[hidden, :WORD_DIM] = 0
        found, cache = net.forward(x, spots, mask[chosen], keep=True)
        error = (1 / (1 + np.exp(-np.clip(found, -30, 30))) - goal) / len(chosen)
        grads = net.backward(x, few, spots, cache, error.astype(np.float32), hidden)
        size = np.sqrt(sum(float((v**2).sum()) for v in grads.values()))
        adam.rate = RATE * (1 - 0.9 * step / STEPS)
        adam.update(net.p, {k: v * min(1.0, 1.0 / (size + 1e-9)) for k, v in grads.items()})
        if step % CHECK_EVERY == 0:
            logits = np.concatenate([_logits(net, part) for part in chunks(check)])
            scale, offset, loss = _calibrate(logits, check_label, toxic_share)
            if loss < best_loss:
                held = BiGru({k: v.copy() for k, v in net.p.items()})
                best, best_loss = Model(held, scale, offset), loss
    return best


def _calibrate(logits: np.ndarray, label: np.ndarray, toxic_share: float) -> tuple[float, float, float]:
    """The scale and offset of least log loss, and that loss."""
    usable = np.isfinite(logits)
    x, y = logits[usable], label[usable]
    if len(x) == 0:
        return 1.0, 0.0, np.inf
    part = np.where(y == 1, toxic_share / max(1, y.sum()), (1 - toxic_share) / max(1, (1 - y).sum()))
    best = (1.0, 0.0, np.inf)
    for offset in np.linspace(x.min(), x.max(), 121):
        for scale in (0.5, 1.0, 2.0, 4.0):
            z = np.clip(scale * (x - offset), -12, 12)
            each = np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)
            loss = float((each * part).sum())
            if loss < best[2]:
                best = (scale, float(offset), loss)
    return best


def _score(column: pa.Array, model: Model | None) -> pa.Array:
    if model is None:
        return pa.array(np.zeros(len(column)))
    z = model.scale * (_logits(model.net, column) - model.offset)
    return pa.array(np.where(np.isfinite(z), 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0))


def score(text: Column, model: Model | None) -> Column:
    """A number from 0 to 1."""
    return text_udf(lambda part: _score(part, model), "double")(text)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from labelled documents outside the fold 0 of 5."""
    known = labels.where((fold("doc_id", 5) != 0) & F.col("toxic").isNotNull())
    labelled = known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("label"))
    share = labelled.agg(F.avg("label")).first()[0]
    if share is None:
        return None
    return train(labelled_sample(docs, labelled, PER_LABEL, MAX_CHARS), float(share))
