"""What a stream's offsets tell: rows lost by a reset, batches missing, batches to be replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What makes a place of one batch worth a look; the others are start, progress and idle.
TROUBLE = ("unreadable", "reset", "gone_back", "new_place")


def audit_offsets(log: DataFrame) -> DataFrame:
    """``sources.progress.offset_log`` with each place held against the one before it.

    ``previous_offset`` and ``previous_batch`` are of the newest earlier batch that knew the place; ``moved`` is
    what was read since. ``missing_batches`` counts the numbers between the two that have no
    offsets. ``verdict`` is

    unreadable    the offset is in no known form
    start         the place is in its source's first batch
    new_place     it came later: a new partition or topic
    reset         its offset went back: it was made anew, and what was in it unread is lost
    gone_back     it went back although the batch before was not committed: offsets were rewritten
    idle          nothing new
    progress      rows were read

    ``replays`` marks batches without a commit: a restart runs them again. A checkpoint keeps a
    bounded number of batches, so one place's rows are few.
    """
    place = Window.partitionBy("source", "topic", "partition").orderBy("batch_id")
    known = F.when(F.col("offset").isNotNull(), F.struct("offset", "batch_id", "committed"))
    before = F.last(known, ignorenulls=True).over(place.rowsBetween(Window.unboundedPreceding, -1))
    first = F.min("batch_id").over(Window.partitionBy("source"))
    batches = log.select("batch_id").distinct()
    seen = batches.select(
        "batch_id", (F.col("batch_id") - F.lag("batch_id").over(Window.orderBy("batch_id")) - 1).alias("_lacking")
    )
    back = F.col("offset") < F.col("_before.offset")
    verdict = (
        F.when(F.col("offset").isNull(), "unreadable")
        .when(F.col("_before").isNull() & (F.col("batch_id") == F.col("_first")), "start")
        .when(F.col("_before").isNull(), "new_place")
        .when(back & ~F.col("_before.committed"), "gone_back")
        .when(back, "reset")
        .when(F.col("offset") == F.col("_before.offset"), "idle")
        .otherwise("progress")
    )
    return (
        log.withColumns({"_before": before, "_first": first})
        .join(seen, "batch_id")
        .select(
            *log.columns,
            F.col("_before.offset").alias("previous_offset"),
            F.col("_before.batch_id").alias("previous_batch"),
            (F.col("offset") - F.col("_before.offset")).alias("moved"),
            F.coalesce("_lacking", F.lit(0)).alias("missing_batches"),
            verdict.alias("verdict"),
            (~F.col("committed")).alias("replays"),
        )
    )


def troubles(audit: DataFrame) -> DataFrame:
    """The rows of an audit that someone should look at."""
    return audit.filter(F.col("verdict").isin(*TROUBLE) | F.col("replays") | (F.col("missing_batches") > 0))
