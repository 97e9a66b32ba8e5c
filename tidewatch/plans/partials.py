"""Reports from partial sums that are written with each batch, so that a refresh reads no rows.

Two small tables per batch, in folders that a replay replaces, as those of the rows are:

``report_counts``  rows per minute, decision, reason and cell of a degree (alerts only); with sums of amounts
``report_newest``  the batch's newest alerts, as many as the report shows

Counts and sums add up, and the newest of all batches are among the newest of each, so the
reports merged from them are those over all rows. They know the decisions as stored, without
corrections made since, and have no points but the cells (``geo_points`` lists rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans import reports
from tidewatch.sinks.tables import write_batch
from tidewatch.sources.tables import load_partials

_PARTS = ("minute", "is_fraud", "fraud_reason", "south", "west")


def counts(results: DataFrame) -> DataFrame:
    """Rows per minute, decision, reason and cell, combined before the shuffle."""
    cell = {
        name: F.when(F.col("is_fraud") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.floor(c))
        for name, c in (("south", "latitude"), ("west", "longitude"))
    }
    minute = F.date_trunc("minute", reports.event_time(results).cast("timestamp"))
    return (
        results.withColumns({"minute": minute, **cell})
        .groupBy(*_PARTS)
        .agg(
            F.count("*").alias("rows"),
            F.count("amount").alias("amounts"),
            F.sum("amount").alias("amount"),
        )
    )


def newest(results: DataFrame) -> DataFrame:
    time = reports.event_time(results).cast("timestamp").alias("event_time")
    alerts = results.filter("is_fraud").select(*reports.LATEST_COLUMNS, time, "is_fraud")
    order = (F.desc("event_time"), "transaction_id")
    return alerts.orderBy(*order).limit(reports.LATEST_ROWS)


def write(results: DataFrame, output_path: str, batch_id: int) -> None:
    """The partial sums of one batch of scored rows, clean rows and alerts together."""
    # Few files of a small batch, and several of a bulk load with many cells.
    write_batch(counts(results).hint("rebalance"), output_path, "report_counts", batch_id)
    write_batch(newest(results), output_path, "report_newest", batch_id)


def kpis(parts: DataFrame) -> DataFrame:
    """``reports.kpis`` from partial counts."""
    total, fraud = F.coalesce(F.sum("rows"), F.lit(0)), F.col("is_fraud")
    alerts = F.coalesce(F.sum(F.when(fraud, F.col("rows"))), F.lit(0))
    mean = F.try_divide(F.sum(F.when(fraud, F.col("amount"))), F.sum(F.when(fraud, F.col("amounts"))))
    return parts.agg(total.alias("total"), alerts.alias("alerts"), mean.alias("avg_alert_amount")).select(
        "total",
        "alerts",
        (F.col("alerts") / F.greatest("total", F.lit(1)) * 100).alias("alert_rate"),
        "avg_alert_amount",
    )


def reason_counts(parts: DataFrame) -> DataFrame:
    """``reports.reason_counts`` from partial counts."""
    return (
        parts.filter(F.col("is_fraud") & F.col("fraud_reason").isNotNull())
        .groupBy(F.col("fraud_reason").alias("reason"))
        .agg(F.sum("rows").alias("alerts"))
        .orderBy(F.desc("alerts"), "reason")
    )


def volume_by_minute(parts: DataFrame) -> DataFrame:
    """``reports.volume_by_minute`` from partial counts."""
    return (
        parts.na.drop(subset=["minute", "is_fraud"])
        .groupBy("minute", "is_fraud")
        .agg(F.sum("rows").alias("rows"))
        .orderBy("minute", "is_fraud")
    )


def geo_grid(parts: DataFrame) -> DataFrame:
    """``reports.geo_grid`` in cells of one degree, from partial counts."""
    return (
        parts.filter("is_fraud")
        .na.drop(subset=["south", "west"])
        .groupBy(F.col("south").cast("double").alias("south"), F.col("west").cast("double").alias("west"))
        .agg(F.sum("rows").alias("alerts"), F.sum("amount").alias("amount"))
    )


def refresh(spark: SparkSession, output_path: str) -> dict[str, DataFrame]:
    """The reports over all batches that have partial sums; no row of the result tables is read."""
    parts, alerts = load_partials(spark, output_path)
    found = {report.__name__: report(parts) for report in (kpis, reason_counts, volume_by_minute, geo_grid)}
    return found | {"latest_alerts": reports.latest_alerts(alerts)}
