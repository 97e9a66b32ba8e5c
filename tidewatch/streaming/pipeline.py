"""The running queries: score a stream into tables, and watch it for bursts."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import RuleConfig, StreamConfig
from tidewatch.functions.messages import parse_transactions
from tidewatch.operators.rapid_fire import burst_rows, hot_windows
from tidewatch.operators.validate import valid_rows, with_reject_reason
from tidewatch.plans import partials
from tidewatch.plans.scoring import apply_rules
from tidewatch.schema import REJECT_SCHEMA, SCORED_SCHEMA
from tidewatch.sinks import tables
from tidewatch.sources.messages import project_records
from tidewatch.streaming.location import locate, with_seeds
from tidewatch.streaming.release import in_time_order

log = logging.getLogger(__name__)


def parse_stream(
    messages: DataFrame,
    rules: RuleConfig,
    stream: StreamConfig | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Broker rows to typed rows, with seeds if the rules look at locations.

    Rows that cannot be scored carry a ``reject_reason`` and their raw message; they do not wait
    where ``stream.ordered`` lets the others wait for the watermark. ``known`` has the last
    rows of users seen before (see ``sources.tables.last_rows``).
    """
    stream = stream or StreamConfig()
    parsed = parse_transactions(project_records(messages), keep_raw=True)
    checked = with_reject_reason(parsed, rules.max_ahead_seconds)
    raw = F.when(F.col("reject_reason").isNotNull(), F.col("raw_message"))
    checked = checked.withColumn("raw_message", raw)
    if stream.ordered:
        if stream.state_ttl_seconds is not None:
            raise ValueError("an ordered stream goes by event time; state_ttl_seconds must be None")
        sound = checked.filter(F.col("reject_reason").isNull())
        waited = in_time_order(sound, stream.watermark, stream.pane_seconds, known)
        rejects = checked.filter(F.col("reject_reason").isNotNull())
        return waited.unionByName(rejects, allowMissingColumns=True)
    if "location_anomaly" not in rules.rules:
        return checked
    return with_seeds(checked, stream.state_ttl_seconds, known)


def score_batch(batch: DataFrame, rules: RuleConfig) -> DataFrame:
    """The scored rows of one micro-batch of ``parse_stream``, rejects included."""
    if "is_seed" in batch.columns:
        batch = locate(batch, rules)
    scored = apply_rules(batch, rules).withColumn(
        "processed_at", F.lit(datetime.now(timezone.utc))
    )
    stored = [c for c in SCORED_SCHEMA.fieldNames() if c in scored.columns]
    return scored.select(*stored, *[c for c in scored.columns if c not in stored])


def process_batch(
    rules: RuleConfig,
    output_path: str,
    on_metrics: Callable[[tables.BatchMetrics], None] | None = None,
    *,
    partial_reports: bool = False,
    batch_records: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The callback for one micro-batch: score it once, write all tables from that.

    Each table's folder for the batch is replaced, so replaying a batch that was
    written but not committed leaves the tables as they were.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if "is_seed" in batch.columns:  # else it is read once, for the scored rows
            batch = batch.persist()
        scored = score_batch(batch, rules).persist()
        try:
            sound = F.col("reject_reason").isNull()
            late = F.col("out_of_order") if "out_of_order" in scored.columns else F.lit(False)
            count = scored.agg(
                F.count_if(sound).alias("total"),
                F.count_if(sound & F.col("is_fraud")).alias("alerts"),
                F.count_if(~sound).alias("rejects"),
                F.count_if(sound & late).alias("out_of_order"),
            ).first()
            if count["total"] + count["rejects"] == 0:
                return
            if batch_records:
                tables.open_batch(scored.sparkSession, output_path, batch_id)
            rows = scored.filter(sound).drop("raw_message", "reject_reason")
            if "late_by" in rows.columns:
                tables.write_late(rows, output_path, batch_id)
            rejects = scored.filter(~sound).select(*REJECT_SCHEMA.fieldNames())
            clean, alerts = count["total"] - count["alerts"], count["alerts"]
            tables.write_clean(rows, output_path, batch_id, clean)
            tables.write_alerts(rows, output_path, batch_id, alerts)
            tables.write_alerts_csv(rows, output_path, batch_id, alerts)
            tables.write_rejects(rejects, output_path, batch_id, count["rejects"])
            if partial_reports:
                partials.write(rows, output_path, batch_id)
            metrics = tables.BatchMetrics(batch_id, **count.asDict())
            if batch_records:
                tables.record_batch(scored.sparkSession, metrics, output_path)
            log.info("%s", metrics)
            if on_metrics:
                on_metrics(metrics)
        finally:
            scored.unpersist()
            batch.unpersist()

    return run


def _trigger(stream: StreamConfig, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": stream.trigger}


def start_scoring(
    messages: DataFrame,
    rules: RuleConfig,
    stream: StreamConfig,
    *,
    available_now: bool = False,
    on_metrics: Callable[[tables.BatchMetrics], None] | None = None,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Score messages into the clean, alert, CSV and reject tables.

    ``known``, the last rows of users in tables that were filled before, is read by the
    query's first batch; a restarted query has it in its state.
    """
    if "rapid_fire" in rules.rules:
        raise ValueError("bursts cross micro-batches; run start_rapid_fire beside this query")
    if available_now and stream.state_ttl_seconds is not None:
        raise ValueError("a query that forgets users by the clock never runs out of batches")
    return (
        parse_stream(messages, rules, stream, known)
        .writeStream.queryName(f"scoring {stream.output_path}")
        .foreachBatch(
            process_batch(
                rules,
                stream.output_path,
                on_metrics,
                partial_reports=stream.partial_reports,
                batch_records=stream.batch_records,
            )
        )
        .option("checkpointLocation", f"{stream.checkpoint_base}/main")
        .trigger(**_trigger(stream, available_now))
        .start()
    )


def rapid_fire_alerts(parsed: DataFrame, rules: RuleConfig, watermark: str) -> DataFrame:
    """Hot windows of a stream. Rows later than the watermark change none of them.

    In append mode each window comes once, when the watermark has passed its
    end; in update mode it comes with every batch that adds to it.
    """
    sound = valid_rows(parsed, rules.max_ahead_seconds)
    return hot_windows(sound.withWatermark("event_time", watermark), rules)


def start_rapid_fire(
    messages: DataFrame,
    rules: RuleConfig,
    stream: StreamConfig,
    *,
    early: bool = False,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the hot windows of a stream to ``rapid_fire_alerts``, when they are final.

    With ``early``, write them to ``rapid_fire_early`` as soon as they are hot, and
    again when they grow: one folder per batch, replaced if the batch is replayed.
    """
    parsed = parse_transactions(project_records(messages))
    name = "rapid_fire_early" if early else "rapid_fire_alerts"
    folder = f"{stream.output_path}/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    writer = (
        rapid_fire_alerts(parsed, rules, stream.watermark)
        .writeStream.queryName(f"{name} {stream.output_path}")
        .option("checkpointLocation", f"{stream.checkpoint_base}/{name}")
        .trigger(**_trigger(stream, available_now))
    )
    if early:
        return writer.outputMode("update").foreachBatch(write).start()
    return writer.outputMode("append").format("parquet").option("path", folder).start()


def start_corrections(
    messages: DataFrame,
    rules: RuleConfig,
    stream: StreamConfig,
    *,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the rows of bursts to ``corrections``, as soon as a burst's window has closed.

    The scoring stream stores a row before it can know of a burst around it, and a burst may lie
    in several of its batches. This query names the rows that such a burst takes in;
    ``reports.corrected_results`` merges them into the stored rows. State is bounded by the
    watermark: open panes, open windows, and the rows that these can still take in.
    """
    sound = valid_rows(parse_transactions(project_records(messages)), rules.max_ahead_seconds)
    return (
        burst_rows(sound.withWatermark("event_time", stream.watermark), rules)
        .writeStream.queryName(f"corrections {stream.output_path}")
        .outputMode("append")
        .format("parquet")
        .option("path", f"{stream.output_path}/corrections")
        .option("checkpointLocation", f"{stream.checkpoint_base}/corrections")
        .trigger(**_trigger(stream, available_now))
        .start()
    )
