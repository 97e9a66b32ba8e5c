"""Count tokens of sections by encoding each document once.

A document is encoded whole, the way a model reads it. Its tokens lie end to end,
so their byte lengths give their character spans, and a sorted interval join
finds the sections that each token meets. A token that crosses a border goes to
the section that has most of its characters, in a tie to the earlier one; a
token with part of one character goes where that character is. So the counts of
a document's sections add up to its count.

A section's text includes the separator behind it. Null and empty texts have one
empty section without tokens; a document without any section gives no row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import list_array

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public pattern that splits a text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RESULT_TYPE = "struct<n_tokens:long,tokens:array<int>,crossing:array<int>>"


class Encoder:
    """Token ids and byte lengths under a vocabulary in rank-file form."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        import tiktoken

        pairs = (line.split() for line in vocabulary.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """The byte at which each token ends."""
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        return np.cumsum(self.width[ids]) if len(ids) else ids


def attribute_text(text: str, lengths: np.ndarray, encoder: Encoder):
    """Tokens and border-crossing tokens of sections with these lengths in characters."""
    ends = encoder.ends(text)
    tokens, crossing = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if len(ends) == 0 or len(lengths) == 0:
        return len(ends), tokens, crossing
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    starts = np.concatenate([[0], ends[:-1]])
    first, last = character[starts], character[ends - 1]
    borders = np.concatenate([[0], np.cumsum(lengths)])
    low = np.searchsorted(borders, first, side="right") - 1
    high = np.searchsorted(borders, last, side="right") - 1
    low, high = np.minimum(low, len(lengths) - 1), np.minimum(high, len(lengths) - 1)
    owner = low.copy()
    for i in np.flatnonzero(low != high):
        met = np.arange(low[i], high[i] + 1)
        shared = np.minimum(borders[met + 1], last[i] + 1) - np.maximum(borders[met], first[i])
        owner[i] = met[np.argmax(shared)]
        crossing[owner[i]] += 1
    np.add.at(tokens, owner, 1)
    return len(ends), tokens, crossing


def attribute(spark: SparkSession, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    """A column function of (text, array of section lengths in characters)."""
    with open(vocabulary, "rb") as file:
        given = spark.sparkContext.broadcast(file.read())  # one file, some MB

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = Encoder(given.value, pattern)
        for texts, lengths in columns:
            total, tokens, crossing, number = [], [], [], []
            for text, parts in zip(texts, lengths, strict=True):
                sizes = np.array(parts.as_py() or [], np.int64)
                n, t, c = attribute_text(text.as_py() or "", sizes, encoder)
                total.append(n)
                tokens.append(t)
                crossing.append(c)
                number.append(len(sizes))
            counts = np.array(number, np.int64)
            flat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(total, pa.int64()),
                    list_array(flat(tokens).astype(np.int32), counts, pa.int32()),
                    list_array(flat(crossing).astype(np.int32), counts, pa.int32()),
                ],
                ["n_tokens", "tokens", "crossing"],
            )

    return F.arrow_udf(run, RESULT_TYPE).asNondeterministic()


def line_lengths(text: Column, separator: str = "\n") -> Column:
    """Characters of each line with the separator behind it."""
    lines = F.split(F.coalesce(text, F.lit("")), separator, -1)
    return F.transform(lines, lambda line: F.length(line) + len(separator))


def by_line(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows doc_id, section (from 1), n_chars, n_tokens, n_crossing, doc_tokens."""
    counted = attribute(docs.sparkSession, vocabulary)
    sized = docs.select("doc_id", "text", line_lengths(F.col("text")).alias("lengths"))
    found = sized.select("doc_id", "lengths", counted("text", "lengths").alias("c"))
    zipped = F.arrays_zip(
        F.col("lengths").alias("n"), F.col("c.tokens").alias("t"), F.col("c.crossing").alias("x")
    )
    rows = found.select("doc_id", F.col("c.n_tokens").alias("doc_tokens"), F.posexplode(zipped))
    return rows.select(
        "doc_id",
        (F.col("pos") + 1).alias("section"),
        (F.col("col.n") - 1).cast("long").alias("n_chars"),
        F.col("col.t").cast("long").alias("n_tokens"),
        F.col("col.x").cast("long").alias("n_crossing"),
        "doc_tokens",
    )


def by_field(df: DataFrame, fields: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with ``field_tokens``, a map from field to its tokens.

    The fields are one text, joined by line breaks; a null field is empty.
    """
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    lengths = F.array(*[F.length(p) + 1 for p in parts])
    found = attribute(df.sparkSession, vocabulary)(F.concat_ws("\n", *parts), lengths)
    names = F.array(*[F.lit(f) for f in fields])
    return df.withColumn("_t", found).select(
        *[df[c] for c in df.columns if c != "field_tokens"],
        F.map_from_arrays(names, F.col("_t.tokens")).alias("field_tokens"),
    )
