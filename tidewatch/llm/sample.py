"""A bounded sample of labelled texts for fitting a model."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labelled: DataFrame, per_label: int, max_chars: int
) -> pa.Table:
    """``text, label`` of at most ``per_label`` documents of each label.

    ``labelled`` has ``doc_id, label``. Only documents with a text of at most ``max_chars``
    characters are usable; of these ids, those first by a hash are chosen, before any text is
    moved. So the sample is bounded in rows and bytes whatever the table's size, and it is
    full if there are enough usable documents.
    """
    usable = docs.where(F.length("text").between(1, max_chars))
    present = labelled.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).join(
        usable.select(F.col("doc_id").alias("_usable")), F.col("doc_id") == F.col("_usable"), "left_semi"
    )
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        present.select("doc_id", "label")
        .distinct()
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_label)
        .select(F.col("doc_id").alias("_doc_id"), "label")
    )
    texts = usable.select("doc_id", "text")
    # Bounded by per_label, so it may be broadcast at any size of the table.
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc_id"))
    once = found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return once.orderBy("label", "doc_id").select("text", "label").toArrow()


def fold(doc_id: str, folds: int):
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds
