"""Transactions and messages derived from an ``events`` table.

``event_id, ts, user_id, event_type, value, props`` becomes a transaction per
event: most in the user's home city, every tenth (``k >= 90``) elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.messages import iso_string, message_value
from tidewatch.sources.cities import CITIES
from tidewatch.sources.messages import file_stream

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(events_path(sf_dir))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream takes a lone file only through one.
    return file_stream(spark, f"{events_path(sf_dir)}*", EVENTS_SCHEMA, "parquet")


def to_transactions(events: DataFrame) -> DataFrame:
    """The message fields, plus ``event_time``.

    The city is an index into literal arrays, not a join, so a query that needs
    only some fields reads only their columns.
    """
    k, cities = F.col("k"), len(CITIES)
    home = F.col("user_id") % cities
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "city_idx", F.when(k >= 90, k % cities).otherwise(home).cast("int")
    )
    names, latitudes, longitudes = (F.array(*map(F.lit, column)) for column in zip(*CITIES))

    def near(centers: Column, modulus: int, shift: int) -> Column:
        step = (F.col("event_id") % modulus - shift).cast("double")
        return F.get(centers, F.col("city_idx")) + step / F.lit(100.0)

    return keyed.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.round("value", 2).alias("amount"),  # cents, as where an amount is made
        iso_string(F.col("ts")).alias("timestamp"),
        F.get(names, F.col("city_idx")).alias("city"),
        near(latitudes, 21, 10).alias("latitude"),
        near(longitudes, 17, 8).alias("longitude"),
        F.col("event_type").alias("transaction_type"),
        F.concat(F.lit("merchant_"), F.col("k")).alias("merchant"),
        (F.col("event_type") == "error").alias("is_seed_fraud"),
        F.col("ts").alias("event_time"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_transactions(read_events(spark, sf_dir))


def to_messages(txns: DataFrame) -> DataFrame:
    """Transactions as a broker would deliver them: binary ``value, timestamp``."""
    return txns.select(
        message_value(txns).cast("binary").alias("value"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )
