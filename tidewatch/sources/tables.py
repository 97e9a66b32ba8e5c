"""Reading result tables back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schema import (
    BATCH_SCHEMA,
    BURST_SCHEMA,
    CORRECTION_SCHEMA,
    COUNTS_SCHEMA,
    LATE_SCHEMA,
    NEWEST_SCHEMA,
    RESULT_SCHEMA,
)


def read_parquet_dir(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    pattern: str = "*.parquet",
    skip_unreadable: bool = False,
) -> DataFrame:
    """All Parquet files at any depth below ``path``; an empty frame if none, or no folder.

    Files still being written (``_temporary``) are never listed. Columns taken
    from folder names, such as ``batch_id``, are not part of the result. An
    unreadable file is an error, unless the caller asks to go on without it.
    """
    reader = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
    )
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_results(spark: SparkSession, output_path: str) -> tuple[DataFrame, DataFrame]:
    """The clean and the alert table, with ``batch_id``, a partition that filters prune."""
    return (
        _read_if_there(spark, f"{output_path}/transactions", RESULT_SCHEMA),
        _read_if_there(spark, f"{output_path}/fraud_alerts", RESULT_SCHEMA),
    )


def load_batches(spark: SparkSession, output_path: str) -> DataFrame:
    """The batches whose tables are all written, with their counts."""
    return _read_if_there(spark, f"{output_path}/batches", BATCH_SCHEMA)


def load_recorded(spark: SparkSession, output_path: str) -> tuple[DataFrame, DataFrame]:
    """The clean and the alert table as ``load_results`` has them, of recorded batches alone.

    So a batch is seen in both tables or in neither; if it is replayed while it is read, the read
    fails, as its files go. The batches are taken as recorded now. The rows of others, mostly
    the one being written, are read and left out. It takes a stream with
    ``StreamConfig.batch_records``, or a backfill that records.
    """
    # Listed before the tables, so that a batch recorded meanwhile is in neither.
    batches = load_batches(spark, output_path).select("batch_id")
    clean, alerts = load_results(spark, output_path)
    whole = (table.join(batches, "batch_id", "left_semi") for table in (clean, alerts))
    return tuple(table.select(*RESULT_SCHEMA.fieldNames()) for table in whole)


def load_bursts(spark: SparkSession, output_path: str) -> DataFrame:
    """The closed hot windows that the burst stream has committed so far."""
    return _read_if_there(spark, f"{output_path}/rapid_fire_alerts", BURST_SCHEMA)


def load_corrections(spark: SparkSession, output_path: str) -> DataFrame:
    """The rows in bursts that the correction stream has committed so far."""
    return _read_if_there(spark, f"{output_path}/corrections", CORRECTION_SCHEMA)


def load_partials(spark: SparkSession, output_path: str) -> tuple[DataFrame, DataFrame]:
    """The partial sums of the reports, and the newest alerts of each batch."""
    return (
        _read_if_there(spark, f"{output_path}/report_counts", COUNTS_SCHEMA),
        _read_if_there(spark, f"{output_path}/report_newest", NEWEST_SCHEMA),
    )


def load_late(spark: SparkSession, output_path: str) -> DataFrame:
    """The rows that came behind the watermark of an ordered stream."""
    return _read_if_there(spark, f"{output_path}/late_rows", LATE_SCHEMA)


def last_rows(spark: SparkSession, output_path: str) -> DataFrame:
    """The last row of each user in the stored tables: where a stream can go on from.

    ``user_id, event_time, transaction_id, latitude, longitude``; combined before the
    shuffle, so a user with very many rows costs one row per task.
    """
    order = ("event_time", "transaction_id", "latitude", "longitude")
    clean, alerts = load_results(spark, output_path)
    rows = clean.select("user_id", *order).unionByName(alerts.select("user_id", *order))
    last = rows.groupBy("user_id").agg(F.max(F.struct(*order)).alias("last"))
    return last.select("user_id", "last.*")


def _read_if_there(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
