"""Language ID: averaged hashed subword embeddings under a linear softmax.

Subwords are runs of 2 to 4 UTF-8 bytes of the lower-case text, everything but
letters and digits being a blank. Each is hashed to a row of the embedding
table; a text is the mean of its rows, and a linear layer with softmax gives a
probability for each language. Trained in numpy by stochastic gradient descent on a bounded
sample. As both layers are linear, their product, one number per row and
language, scores whole texts of any length in one pass.

Probabilities are calibrated by a temperature fitted on documents kept out of
training, and a text is rejected if its best one is below the level that keeps
``KEEP`` of those, or if it has no letter.

Null texts and texts without a letter are ``und`` with score 0, and rejected. With
no labelled row at all there is nothing to learn and every text is ``und``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words
from tidewatch.llm.common import bytes_of, chunks, segments, text_udf
from tidewatch.llm.sample import fold, labelled_sample

#: The bound of the training sample: documents per language, characters of each.
PER_LANGUAGE, MAX_CHARS = 800, 20_000
ORDERS = (2, 3, 4)
BUCKETS, DIM = 1 << 16, 8
PIECE, PIECES, BATCH, EPOCHS, RATE = 192, 12, 64, 3, 0.5
KEEP = 0.999
MAX_REJECT = 0.5
RESULT_TYPE = "struct<lang:string,score:double,rejected:boolean>"
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also fractions, superscripts and circled numbers
_TABLE = np.where(words._IS_WORD, np.arange(256), 32).astype(np.uint32)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    reject_below: float


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table and their number per text, in text order."""
    data, borders = bytes_of(pc.utf8_lower(column))
    if len(data) == 0:
        return np.empty(0, np.int32), np.zeros(len(column), np.int64)
    plain = _TABLE[data]
    owner = segments(np.diff(borders)).astype(np.int32)
    ids, owners = [], []
    for n in ORDERS:
        if len(plain) < n:
            continue
        size = len(plain) - n + 1
        value = np.full(size, n, np.uint32)
        for k in range(n):
            value = (value ^ plain[k : k + size]) * np.uint32(0x01000193)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA6B)
        inside = owner[:size] == owner[n - 1 :]
        inside &= (plain[:size] != 32) | (plain[n - 1 :] != 32)
        ids.append((value[inside] >> np.uint32(16)).astype(np.int32))
        owners.append(owner[:size][inside])
    if not ids:
        return np.empty(0, np.int32), np.zeros(len(column), np.int64)
    joined = np.concatenate(owners)
    order = np.argsort(joined, kind="stable")
    return np.concatenate(ids)[order], np.bincount(joined, minlength=len(column))


def _logits(column: pa.Array, model: Model) -> np.ndarray:
    ids, counts = subwords(column)
    out = np.tile(model.bias, (len(column), 1)).astype(np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        for k in range(len(model.languages)):
            out[full, k] += np.add.reduceat(model.weights[:, k][ids], begin) / counts[full]
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(sample: pa.Table, seed: int = 5) -> Model | None:
    """Fit on ``text, label``; every fifth document is kept out to calibrate."""
    languages = sorted(set(sample["label"].to_pylist()))
    if not languages:
        return None
    target = np.array([languages.index(x) for x in sample["label"].to_pylist()])
    texts = sample["text"].combine_chunks()
    rng = np.random.default_rng(seed)
    kept_out = np.zeros(len(target), bool)
    kept_out[rng.permutation(len(target))[: len(target) // 5]] = True
    pieces, labels = [], []
    at = 0
    for part in chunks(texts):
        ids, counts = subwords(part)
        begin = np.cumsum(counts) - counts
        for i, (b, n) in enumerate(zip(begin, counts, strict=True)):
            if kept_out[at + i] or n == 0:
                continue
            # Rows of a piece stand in order of subword length, so draw them at random.
            number = min(PIECES, -(-n // PIECE))
            drawn = rng.integers(0, n, (number, PIECE))
            pieces.append(ids[b + drawn])
            labels += [target[at + i]] * number
        at += len(part)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    linear = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    linear += rng.normal(0, 0.1, linear.shape).astype(np.float32)
    if pieces:
        x, y = np.concatenate(pieces), np.array(labels)
        # Each language counts the same, however many documents it has.
        weight = len(y) / len(languages) / np.maximum(np.bincount(y, minlength=len(languages)), 1)
        steps = EPOCHS * -(-len(y) // BATCH)
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for first in range(0, len(y), BATCH):
                rows = order[first : first + BATCH]
                rate = RATE * (1 - step / steps)
                hidden = embedding[x[rows]].mean(axis=1)
                error = _softmax(hidden @ linear + bias)
                error[np.arange(len(rows)), y[rows]] -= 1
                error *= weight[y[rows]][:, None] / len(rows)
                back = (error @ linear.T).astype(np.float32)
                linear -= (rate * 20 * hidden.T @ error).astype(np.float32)
                bias -= (rate * error.sum(axis=0)).astype(np.float32)
                spread = np.repeat(back * (rate * 20 / 1.0), PIECE, axis=0)
                np.add.at(embedding, x[rows].ravel(), -spread)
                step += 1
    model = Model(languages, (embedding @ linear).astype(np.float32), bias, 1.0, 0.0)
    _calibrate(model, texts.filter(pa.array(kept_out)), target[kept_out])
    return model


def _calibrate(model: Model, texts: pa.Array, target: np.ndarray) -> None:
    if len(target) < 10:
        return
    logits = np.concatenate([_logits(part, model) for part in chunks(texts)])
    rows = np.arange(len(target))

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[rows, target] + 1e-12).mean()

    model.temperature = float(min(np.geomspace(0.02, 5, 60), key=loss))
    best = _softmax(logits / model.temperature).max(axis=1)
    model.reject_below = float(min(MAX_REJECT, np.quantile(best, 1 - KEEP)))


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


def _predict(column: pa.Array, model: Model | None) -> pa.Array:
    lettered = np.array([has_letter(t) for t in column.to_pylist()], bool)
    lang = np.full(len(column), "und", object)
    score, rejected = np.zeros(len(column)), np.ones(len(column), bool)
    if model and len(column):
        share = _softmax(_logits(column, model) / model.temperature)
        best = share.argmax(axis=1)
        lang[lettered] = np.array(model.languages, object)[best][lettered]
        score[lettered] = np.clip(share.max(axis=1), 0, 1)[lettered]
        rejected[lettered] = (score < model.reject_below)[lettered]
    arrays = [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)]
    return pa.StructArray.from_arrays(arrays, ["lang", "score", "rejected"])


def predict(text: Column, model: Model | None) -> Column:
    """A struct lang, score, rejected."""
    return text_udf(lambda part: _predict(part, model), RESULT_TYPE)(text)


def fit(docs: DataFrame) -> Model | None:
    """Learn from documents of the folds 0, 1 and 3 of 4 that have a language."""
    known = docs.where(fold("doc_id", 4) != 2)
    labelled = known.select("doc_id", F.col("lang").alias("label"))
    return train(labelled_sample(known, labelled, PER_LANGUAGE, MAX_CHARS))
