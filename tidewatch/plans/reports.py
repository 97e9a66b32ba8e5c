"""Summaries of the result tables.

Each takes ``results``: clean rows and alerts together, told apart by
``is_fraud`` (see ``union_results``). Every report aggregates or limits on the
cluster; callers collect only what it returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import RuleConfig
from tidewatch.functions.messages import parse_event_time
from tidewatch.operators.rapid_fire import correct, stamp_bursts
from tidewatch.sources.tables import load_bursts, load_corrections, load_results

# The columns of two reports.
LATEST_COLUMNS = ("transaction_id", "user_id", "amount", "city", "fraud_reason", "timestamp")
GEO_COLUMNS = ("latitude", "longitude", "amount", "city", "user_id", "fraud_reason")
LATEST_ROWS = 20


def union_results(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    return transactions.unionByName(alerts, allowMissingColumns=True)


def kpis(results: DataFrame) -> DataFrame:
    """Total rows, alerts, alert rate in percent, and mean alert amount, in one pass."""
    return results.agg(
        F.count("*").alias("total"),
        F.count_if("is_fraud").alias("alerts"),
        F.avg(F.when(F.col("is_fraud"), F.col("amount"))).alias("avg_alert_amount"),
    ).select(
        "total",
        "alerts",
        (F.col("alerts") / F.greatest("total", F.lit(1)) * 100).alias("alert_rate"),
        "avg_alert_amount",
    )


def event_time(results: DataFrame) -> Column:
    """The stored time; parsed from the text only where a table has none."""
    return F.col("event_time") if "event_time" in results.columns else parse_event_time("timestamp")


def latest_alerts(results: DataFrame, rows: int = LATEST_ROWS) -> DataFrame:
    """The newest alerts, with the severity mark the high-value ones get.

    Sorted by time; the text is chronological only in one time zone.
    """
    newest = (
        results.filter("is_fraud")
        .withColumn("_time", event_time(results))
        .orderBy(F.desc("_time"), "transaction_id")
        .limit(rows)
    )
    shown = [c for c in LATEST_COLUMNS if c in results.columns]
    severe = F.coalesce(F.col("fraud_reason").contains("high_value"), F.lit(False))
    return newest.select(*shown, severe.alias("is_high_value"))


def reason_counts(results: DataFrame) -> DataFrame:
    """Alerts per reason, most frequent first."""
    return (
        results.filter(F.col("is_fraud") & F.col("fraud_reason").isNotNull())
        .groupBy(F.col("fraud_reason").alias("reason"))
        .agg(F.count("*").alias("alerts"))
        .orderBy(F.desc("alerts"), "reason")
    )


def volume_by_minute(results: DataFrame) -> DataFrame:
    """Rows per minute and decision; rows without a readable time are left out."""
    return (
        results.select(event_time(results).alias("ts"), "is_fraud")
        .na.drop(subset=["ts", "is_fraud"])
        .groupBy(F.date_trunc("minute", "ts").alias("minute"), "is_fraud")
        .agg(F.count("*").alias("rows"))
        .orderBy("minute", "is_fraud")
    )


def geo_points(results: DataFrame) -> DataFrame:
    """Where the alerts happened; rows without coordinates are left out."""
    return results.filter("is_fraud").select(*GEO_COLUMNS).na.drop(subset=["latitude", "longitude"])


def geo_grid(results: DataFrame, degrees: float = 1.0) -> DataFrame:
    """Alerts per cell of latitude and longitude: a bounded form of ``geo_points``."""
    south, west = (F.floor(F.col(c) / degrees) * degrees for c in ("latitude", "longitude"))
    return (
        geo_points(results)
        .groupBy(south.alias("south"), west.alias("west"))
        .agg(F.count("*").alias("alerts"), F.sum("amount").alias("amount"))
    )


def stored_results(
    spark: SparkSession, output_path: str, config: RuleConfig | None = None
) -> DataFrame:
    """Clean rows and alerts below ``output_path``, with the bursts found since.

    The scoring stream stores a row before it can know of a burst around it; the
    burst stream stores each burst when its window has closed. Here they meet. The
    window's length and slide must be those of the burst stream.
    """
    results = union_results(*load_results(spark, output_path))
    return stamp_bursts(results, load_bursts(spark, output_path), config or RuleConfig())


def corrected_results(spark: SparkSession, output_path: str) -> DataFrame:
    """Clean rows and alerts below ``output_path``, merged with the corrections made since.

    As ``stored_results``, for a correction stream in place of a burst stream. The merge goes by
    row, so it does not ask for the rule's window.
    """
    results = union_results(*load_results(spark, output_path))
    return correct(results, load_corrections(spark, output_path))


def refresh(
    spark: SparkSession, output_path: str, config: RuleConfig | None = None
) -> dict[str, DataFrame]:
    """All reports over the tables below ``output_path`` as they are now."""
    results = stored_results(spark, output_path, config)
    reports = (kpis, latest_alerts, reason_counts, volume_by_minute, geo_points, geo_grid)
    return {report.__name__: report(results) for report in reports}
