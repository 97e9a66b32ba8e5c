"""Column layouts of messages and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The message fields, in order.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("is_seed_fraud", T.BooleanType()),
    ]
)

# Columns that are kept out of the CSV copy of the alerts.
DEBUG_COLUMNS = ("prev_lat", "prev_lon", "distance_km")

# The scored table as stored in Parquet, whatever rules are active: the columns of
# a rule that is off are NULL.
SCORED_SCHEMA = T.StructType(
    [
        *TRANSACTION_SCHEMA.fields,
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("fraud_high_value", T.BooleanType()),
        T.StructField("fraud_rapid_fire", T.BooleanType()),
        T.StructField("prev_lat", T.DoubleType()),
        T.StructField("prev_lon", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("fraud_location_anomaly", T.BooleanType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("fraud_reason", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("out_of_order", T.BooleanType()),
    ]
)
# As read back: the folder's batch is a column too.
RESULT_SCHEMA = T.StructType([*SCORED_SCHEMA.fields, T.StructField("batch_id", T.LongType())])

ALERT_CSV_SCHEMA = T.StructType([f for f in SCORED_SCHEMA.fields if f.name not in (*DEBUG_COLUMNS, "out_of_order")])

REJECT_SCHEMA = T.StructType(
    [
        *TRANSACTION_SCHEMA.fields,
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("raw_message", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)


# Rows that came behind the watermark of an ordered stream.
LATE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("late_by", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

# Bursts as the burst stream stores them.
BURST_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("txn_count", T.LongType()),
    ]
)


# Rows that lie in a burst, as the correction stream stores them.
CORRECTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        *BURST_SCHEMA.fields[1:],
    ]
)


# Partial sums of the reports, and each batch's newest alerts.
COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("fraud_reason", T.StringType()),
        T.StructField("south", T.LongType()),
        T.StructField("west", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("amounts", T.LongType()),
        T.StructField("amount", T.DoubleType()),
    ]
)
NEWEST_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("fraud_reason", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)


# One row per batch whose tables are all written.
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("rejects", T.LongType()),
        T.StructField("out_of_order", T.LongType()),
        T.StructField("alert_rate", T.DoubleType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)


def stored_columns(df: DataFrame) -> DataFrame:
    """``df`` in the stored layout: all columns, in order, NULL where it has none."""
    own = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name)
            for f in SCORED_SCHEMA.fields
        ]
    )
