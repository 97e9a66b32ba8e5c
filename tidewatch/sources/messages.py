"""Streams of JSON messages: the broker, and files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.config import StreamConfig


def kafka_options(config: StreamConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if config.max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(config)).load()


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str, max_files: int | None = None
) -> DataFrame:
    """Files of messages as they arrive below ``path``, oldest first."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One message per line; a message's time is that of its file, also on replay."""
    schema = StructType().add("value", "string")
    lines = file_stream(spark, path, schema, "text", max_files)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def project_records(messages: DataFrame) -> DataFrame:
    """Raw broker rows to ``json_str, kafka_ts``; the value may be binary or text."""
    return messages.select(
        F.col("value").cast("string").alias("json_str"), F.col("timestamp").alias("kafka_ts")
    )
