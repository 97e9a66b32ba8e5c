"""The high-value and location rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import RuleConfig
from tidewatch.functions.geo import haversine_km
from tidewatch.operators.history import PREVIOUS_LOCATION, add_history, heavy_users


def flag_high_value(df: DataFrame, config: RuleConfig) -> DataFrame:
    return df.withColumn("fraud_high_value", F.col("amount") > F.lit(config.amount_limit))


def previous_location(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Add ``prev_lat, prev_lon``: where the user's previous transaction was."""
    return add_history(df, config, heavy_users(df, config), previous=PREVIOUS_LOCATION)


def flag_distance(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Add distance and flag to rows that already carry ``prev_lat, prev_lon``.

    The distance is never NULL, so neither is the flag.
    """
    distance = haversine_km(
        F.col("prev_lat"), F.col("prev_lon"), F.col("latitude"), F.col("longitude")
    )
    return df.withColumn("distance_km", distance).withColumn(
        "fraud_location_anomaly", F.col("distance_km") > F.lit(config.distance_limit_km)
    )


def flag_location(df: DataFrame, config: RuleConfig) -> DataFrame:
    return flag_distance(previous_location(df, config), config)
