"""Result tables. Each batch owns one folder per table, replaced on replay."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.routing import alert_rows, clean_rows
from tidewatch.schema import ALERT_CSV_SCHEMA, BATCH_SCHEMA, LATE_SCHEMA, stored_columns
from tidewatch.session import remove

ROWS_PER_FILE = 1_000_000
CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ = {**CSV_WRITE, "multiLine": "true"}


@dataclass(frozen=True)
class BatchMetrics:
    batch_id: int
    total: int
    alerts: int
    rejects: int = 0
    out_of_order: int = 0

    @property
    def rate(self) -> float:
        return self.alerts / max(self.total, 1) * 100

    def __str__(self) -> str:
        return (
            f"batch_id={self.batch_id} rows={self.total} alerts={self.alerts} "
            f"alert_percent={self.rate:.1f} rejects={self.rejects} out_of_order={self.out_of_order}"
        )


def batch_metrics(scored: DataFrame) -> DataFrame:
    """``total, alerts, alert_rate`` of a scored batch in one pass."""
    return scored.agg(
        F.count("*").alias("total"), F.count_if("is_fraud").alias("alerts")
    ).withColumn("alert_rate", F.col("alerts") / F.greatest("total", F.lit(1)) * 100)


def _sized(df: DataFrame, rows: int | None) -> DataFrame:
    """Few rows, few files, when the count is known.

    The filter before it runs in all tasks; only the rows that are left move.
    """
    return df if rows is None else df.repartition(max(1, ceil(rows / ROWS_PER_FILE)))


def _batch_folder(output_path: str, table: str, batch_id: int) -> str:
    return f"{output_path}/{table}/batch_id={batch_id}"


def _write_parquet(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(folder)


def write_batch(df: DataFrame, output_path: str, table: str, batch_id: int) -> None:
    """``df`` as a batch's folder of a table, in place of what is there."""
    _write_parquet(df, _batch_folder(output_path, table, batch_id))


def open_batch(spark: SparkSession, output_path: str, batch_id: int) -> None:
    """Before a batch's tables are written: it is not recorded, or, if it is replayed, no more."""
    remove(spark, _batch_folder(output_path, "batches", batch_id))


def record_batch(spark: SparkSession, metrics: BatchMetrics, output_path: str) -> None:
    """After all tables of a batch are written: its counts, as the sign that it is whole."""
    counts = (metrics.total, metrics.alerts, metrics.rejects, metrics.out_of_order)
    row = (metrics.batch_id, *counts, metrics.rate, datetime.now(timezone.utc))
    record = spark.createDataFrame([row], BATCH_SCHEMA).drop("batch_id").coalesce(1)
    write_batch(record, output_path, "batches", metrics.batch_id)


def write_clean(
    scored: DataFrame, output_path: str, batch_id: int, rows: int | None = None
) -> None:
    folder = _batch_folder(output_path, "transactions", batch_id)
    _write_parquet(_sized(stored_columns(clean_rows(scored)), rows), folder)


def write_alerts(
    scored: DataFrame, output_path: str, batch_id: int, rows: int | None = None
) -> None:
    folder = _batch_folder(output_path, "fraud_alerts", batch_id)
    _write_parquet(_sized(stored_columns(alert_rows(scored)), rows), folder)


def write_alerts_csv(
    scored: DataFrame, output_path: str, batch_id: int, rows: int | None = None
) -> None:
    folder = _batch_folder(output_path, "fraud_alerts_csv", batch_id)
    layout = stored_columns(alert_rows(scored)).select(*ALERT_CSV_SCHEMA.fieldNames())
    _sized(layout, rows).write.mode("overwrite").options(**CSV_WRITE).csv(folder)


def read_alerts_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV copy, text as it was: spaces, quotes and line breaks included."""
    return spark.read.schema(ALERT_CSV_SCHEMA).options(**CSV_READ).csv(path)


def write_rejects(
    rejects: DataFrame, output_path: str, batch_id: int, rows: int | None = None
) -> None:
    _write_parquet(_sized(rejects, rows), _batch_folder(output_path, "rejects", batch_id))


def write_late(rows: DataFrame, output_path: str, batch_id: int) -> None:
    """The rows that came behind the watermark, with ``late_by`` in seconds, as a table of their own.

    They are in the result tables too, marked ``out_of_order`` there if their user has been
    seen later.
    """
    late = rows.filter(F.col("late_by").isNotNull()).select(*LATE_SCHEMA.fieldNames())
    _write_parquet(late.coalesce(1), _batch_folder(output_path, "late_rows", batch_id))
