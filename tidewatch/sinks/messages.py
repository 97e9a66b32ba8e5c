"""Transactions out as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.config import StreamConfig
from tidewatch.functions.messages import message_value


def to_values(txns: DataFrame) -> DataFrame:
    return txns.select(message_value(txns).alias("value"))


def write_text(txns: DataFrame, path: str) -> None:
    """One message per line."""
    to_values(txns).write.mode("append").text(path)


def write_kafka(txns: DataFrame, config: StreamConfig) -> None:
    """To a topic, acknowledged by all replicas. Needs the Kafka connector."""
    (
        to_values(txns)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", config.bootstrap_servers)
        # Acknowledgement and retries.
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", config.topic)
        .save()
    )
