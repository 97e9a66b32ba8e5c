"""Bursts of activity per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FLAG_COLUMNS, RuleConfig
from tidewatch.functions.flags import any_flag, fill_flags, reason_label
from tidewatch.operators.history import add_history, heavy_users, pane
from tidewatch.operators.skew import left_join_on_key


#: What names a row in the table of corrections.
CORRECTION_KEYS = ("transaction_id", "user_id", "event_time")


def window_counts(df: DataFrame, config: RuleConfig) -> DataFrame:
    """``user_id, window, txn_count`` per sliding window; batch or streaming.

    Counts are combined before the shuffle, so a busy user costs one row per
    window and task.
    """
    window = F.window(
        "event_time",
        f"{config.rapid_window_seconds} seconds",
        f"{config.rapid_slide_seconds} seconds",
    )
    return df.groupBy("user_id", window.alias("window")).agg(F.count("*").alias("txn_count"))


def hot_windows(df: DataFrame, config: RuleConfig) -> DataFrame:
    """The windows above the limit, as ``user_id, window_start, window_end, txn_count``."""
    return (
        window_counts(df, config)
        .filter(F.col("txn_count") > config.rapid_limit)
        .select(
            "user_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "txn_count",
        )
    )


def window_counts_by_pane(df: DataFrame, config: RuleConfig) -> DataFrame:
    """The same counts from counts per pane of one slide, so that no row is repeated for its windows.

    In a stream these are two stateful aggregates, one after the other, in append mode; a row
    behind the watermark counts if its pane is still open.
    """
    slide = f"{config.rapid_slide_seconds} seconds"
    panes = df.groupBy("user_id", F.window("event_time", slide).alias("pane")).agg(
        F.count("*").alias("pane_count")
    )
    window = F.window("pane", f"{config.rapid_window_seconds} seconds", slide)
    return panes.groupBy("user_id", window.alias("window")).agg(
        F.sum("pane_count").alias("txn_count")
    )


def burst_rows(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Each row with each hot window that it lies in; batch, or a stream with a watermark.

    ``transaction_id, user_id, event_time, window_start, window_end, txn_count``. In a stream a
    window's rows come when it has closed. Until then they are kept by the join, which lets go of a
    row when the watermark is a window's length behind it. Rows and windows meet by user and
    pane, so a busy user's rows are spread over tasks by time.
    """
    slide, size = config.rapid_slide_seconds, config.rapid_window_seconds
    hot = window_counts_by_pane(df, config).filter(F.col("txn_count") > config.rapid_limit)
    step = F.lit(slide * 1_000_000)
    first, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window.start", "window.end"))
    hot = hot.select(
        F.col("user_id").alias("_user"),
        F.explode(F.sequence(first, end - step, step)).alias("_hot_pane"),
        F.window_time("window").alias("_last"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "txn_count",
    )
    rows = df.select(*CORRECTION_KEYS, pane(slide).alias("_pane"))
    # The pane decides; the times tell a stream how long a row can still be asked for.
    near = F.col("event_time") > F.col("_last") - F.expr(f"interval {size} seconds")
    meets = (F.col("user_id") == F.col("_user")) & (F.col("_pane") == F.col("_hot_pane"))
    joined = rows.join(hot, meets & near & (F.col("event_time") <= F.col("_last")))
    return joined.select(*CORRECTION_KEYS, "window_start", "window_end", "txn_count")


def flag_users(df: DataFrame, config: RuleConfig) -> DataFrame:
    """User grain: all rows of a user who ever had a hot window are flagged."""
    flagged = (
        hot_windows(df, config).select("user_id", F.lit(True).alias("fraud_rapid_fire")).distinct()
    )
    joined = left_join_on_key(df, flagged, "user_id", heavy_users(df, config))
    return fill_flags(joined, ["fraud_rapid_fire"])


def flag_rows(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Row grain: the rows that lie in a hot window are flagged."""
    counted = add_history(df, config, heavy_users(df, config), counts=True)
    return add_flag(counted, config)


def stamp_bursts(results: DataFrame, windows: DataFrame, config: RuleConfig) -> DataFrame:
    """Stored rows with the bursts that a stream has reported since they were scored.

    A row lies in one of ``windows`` if its pane is one of theirs, so the windows,
    which are few, are spread over their panes, and no row is repeated. Decision
    and label are made anew from all flags; columns keep their order.
    """
    slide = config.rapid_slide_seconds * 1_000_000
    first, end = F.unix_micros("window_start"), F.unix_micros("window_end")
    panes = F.explode(F.sequence(first, end - slide, F.lit(slide)))
    hot = windows.select("user_id", panes.alias("_pane")).distinct()
    joined = results.withColumn("_pane", pane(config.rapid_slide_seconds)).join(
        hot.withColumn("_hot", F.lit(True)), ["user_id", "_pane"], "left"
    )
    return _stamped(joined, results.columns)


def correct(results: DataFrame, corrections: DataFrame) -> DataFrame:
    """Stored rows, those named in ``corrections`` with the burst flag, decision and label anew.

    A row is named by id, user and time; any number of corrections of it are as one.
    """
    named = corrections.select(*CORRECTION_KEYS).distinct().withColumn("_hot", F.lit(True))
    return _stamped(results.join(named, [*CORRECTION_KEYS], "left"), results.columns)


def _stamped(joined: DataFrame, columns: list[str]) -> DataFrame:
    known = F.coalesce("fraud_rapid_fire", F.lit(False))
    flagged = joined.withColumn("fraud_rapid_fire", known | F.col("_hot").isNotNull())
    return flagged.withColumns(
        {"is_fraud": any_flag(FLAG_COLUMNS.values()), "fraud_reason": reason_label(FLAG_COLUMNS)}
    ).select(*columns)


def add_flag(df: DataFrame, config: RuleConfig) -> DataFrame:
    flag = F.coalesce(F.col("rapid_count") > config.rapid_limit, F.lit(False))
    return df.withColumn("fraud_rapid_fire", flag).drop("rapid_count")
