"""Scoring a large stored input into the result tables, each pass over it once.

Between steps the rows rest in Parquet below ``_staging``: messages are parsed
once although scoring reads them twice (it first counts rows per user, from one
column), and rows are scored once although three tables are written from them.
A lost executor costs the running step only, a rerun replaces what it wrote, and
the folder goes when all tables are written. The raw message is kept for rejects only.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import MAX_AHEAD_SECONDS, RuleConfig
from tidewatch.functions.messages import parse_transactions
from tidewatch.operators.validate import with_reject_reason
from tidewatch.plans import partials
from tidewatch.plans.scoring import score_transactions
from tidewatch.schema import REJECT_SCHEMA, stored_columns
from tidewatch.session import remove
from tidewatch.sinks import tables
from tidewatch.sources.messages import project_records


def rest(df: DataFrame, folder: str) -> DataFrame:
    """The same rows, written to ``folder`` and read from there."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def land_messages(
    messages: DataFrame, output_path: str, batch_id: int, max_ahead: int = MAX_AHEAD_SECONDS
) -> DataFrame:
    """Broker rows as a table of typed rows, rejects included."""
    parsed = parse_transactions(project_records(messages), keep_raw=True)
    checked = with_reject_reason(parsed, max_ahead)
    raw = F.when(F.col("reject_reason").isNotNull(), F.col("raw_message"))
    checked = checked.withColumn("raw_message", raw)
    return rest(checked, f"{_staging(output_path, batch_id)}/parsed")


def _staging(output_path: str, batch_id: int) -> str:
    return f"{output_path}/_staging/batch_id={batch_id}"


def score_landed(
    landed: DataFrame, config: RuleConfig, output_path: str, batch_id: int
) -> DataFrame:
    """The scored rows of a landed table, themselves at rest."""
    now = F.lit(datetime.now(timezone.utc))
    rows = landed.filter(F.col("reject_reason").isNull()).drop("raw_message", "reject_reason")
    scored = score_transactions(rows, config).withColumn("processed_at", now)
    return rest(stored_columns(scored), f"{_staging(output_path, batch_id)}/scored")


def backfill(
    messages: DataFrame,
    config: RuleConfig,
    output_path: str,
    batch_id: int,
    *,
    partial_reports: bool = False,
    batch_records: bool = False,
) -> None:
    """Write the clean, alert, CSV and reject tables of one bulk input; if asked to, its partial sums and record."""
    spark = messages.sparkSession
    if batch_records:
        tables.open_batch(spark, output_path, batch_id)
    landed = land_messages(messages, output_path, batch_id, config.max_ahead_seconds)
    scored = score_landed(landed, config, output_path, batch_id)
    tables.write_clean(scored, output_path, batch_id)
    tables.write_alerts(scored, output_path, batch_id)
    tables.write_alerts_csv(scored, output_path, batch_id)
    if partial_reports:
        partials.write(scored, output_path, batch_id)
    now = F.lit(datetime.now(timezone.utc))
    rejects = landed.filter(F.col("reject_reason").isNotNull()).withColumn("processed_at", now)
    tables.write_rejects(rejects.select(*REJECT_SCHEMA.fieldNames()), output_path, batch_id)
    if batch_records:
        counts = tables.batch_metrics(scored).first()
        lost = landed.filter(F.col("reject_reason").isNotNull()).count()
        metrics = tables.BatchMetrics(batch_id, counts["total"], counts["alerts"], lost)
        tables.record_batch(spark, metrics, output_path)
    remove(spark, _staging(output_path, batch_id))
