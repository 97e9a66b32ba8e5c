"""JSON messages: parsing, and building them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schema import TRANSACTION_SCHEMA

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"  # Fixed value: wire format of times.


def parse_event_time(text: str | Column) -> Column:
    """ISO-8601 text to a timestamp; NULL (never an error) if it cannot be read."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def iso_string(time: Column) -> Column:
    """Timestamp to ISO-8601 text with microseconds and offset (session zone UTC)."""
    return F.date_format(time, ISO_PATTERN)


def parse_transactions(
    records: DataFrame, keep_raw: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """``json_str, kafka_ts`` rows to typed transactions with a parsed ``event_time``.

    Parsing is permissive: a malformed message gives NULL fields, a field of the
    wrong type a NULL in that field only. Nothing is dropped here.

    The parsed struct passes through ``explode`` of a one-element array, which
    keeps the row count and keeps the optimizer from copying ``from_json`` into
    every filter over the fields: each message is parsed once. ``keep_raw`` adds
    the text as ``raw_message``; ``keep`` names further columns to carry along.
    """
    raw = [F.col("json_str").alias("raw_message")] if keep_raw else []
    data = F.from_json("json_str", TRANSACTION_SCHEMA)
    return records.select(
        F.explode(F.array(data)).alias("data"), "kafka_ts", *raw, *keep
    ).select(
        "data.*",
        "kafka_ts",
        parse_event_time("data.timestamp").alias("event_time"),
        *(["raw_message"] if keep_raw else []),
        *keep,
    )


def message_value(df: DataFrame) -> Column:
    """The JSON text of a transaction: the message fields in order, NULLs included."""
    fields = F.struct(*TRANSACTION_SCHEMA.fieldNames())
    return F.to_json(fields, {"ignoreNullFields": "false"})
