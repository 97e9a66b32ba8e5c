"""Telling scorable transactions from rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import MAX_AHEAD_SECONDS

INFINITY = float("inf")


def finite_amount() -> Column:
    """True or NULL-free false. NaN sorts above infinity, so it is not finite."""
    finite = (F.col("amount") > F.lit(-INFINITY)) & (F.col("amount") < F.lit(INFINITY))
    return F.col("amount").isNotNull() & finite


def ahead_of_arrival(df: DataFrame, seconds: int) -> Column:
    """The row says it happened well after it arrived. Never NULL.

    Such a time would move a watermark, and a user's last sighting, past all that
    follows. A row without a time of arrival is not judged.
    """
    if "kafka_ts" not in df.columns:
        return F.lit(False)
    limit = F.col("kafka_ts").cast("timestamp") + F.make_dt_interval(secs=F.lit(seconds))
    return F.coalesce(F.col("event_time").cast("timestamp") > limit, F.lit(False))


def reject_reason(df: DataFrame, max_ahead: int = MAX_AHEAD_SECONDS) -> Column:
    """Why a row cannot be scored, NULL if it can be.

    A NaN amount would pass ``amount > limit`` and a NULL one would fall out of
    both sides of the routing, so both are rejected by name.
    """
    nothing = (
        F.col("transaction_id").isNull()
        & F.col("user_id").isNull()
        & F.col("amount").isNull()
        & F.col("event_time").isNull()
    )
    return (
        F.when(nothing, "malformed_message")
        .when(F.col("transaction_id").isNull(), "missing_transaction_id")
        .when(F.col("user_id").isNull(), "missing_user_id")
        .when(~finite_amount(), "invalid_amount")
        .when(F.col("event_time").isNull(), "invalid_event_time")
        .when(ahead_of_arrival(df, max_ahead), "future_event_time")
    )


def with_reject_reason(df: DataFrame, max_ahead: int = MAX_AHEAD_SECONDS) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(df, max_ahead))


def valid_rows(df: DataFrame, max_ahead: int = MAX_AHEAD_SECONDS) -> DataFrame:
    """The rows without a reject reason, as plain predicates a scan can take over."""
    return df.filter(
        F.col("transaction_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_time").isNotNull()
        & finite_amount()
        & ~ahead_of_arrival(df, max_ahead)
    )


def rejected_rows(df: DataFrame, max_ahead: int = MAX_AHEAD_SECONDS) -> DataFrame:
    """The other rows, each with its ``reject_reason``."""
    return with_reject_reason(df, max_ahead).filter(F.col("reject_reason").isNotNull())
