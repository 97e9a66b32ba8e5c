"""Every operator as a query over the ``events`` table of a data folder.

Times are returned without zone (they are UTC), so that other engines compare
them as plain values. Limits suit the table (see ``TABLE_RULES``); the defaults
of ``RuleConfig`` are meant for live transactions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import RULES, RuleConfig, StreamConfig
from tidewatch.functions import flags, messages
from tidewatch.functions.geo import haversine_km
from tidewatch.operators import rapid_fire, routing, rules, validate
from tidewatch.operators.offset_audit import audit_offsets
from tidewatch.plans import partials, reports, scoring
from tidewatch.plans.backfill import backfill, land_messages, score_landed
from tidewatch.schema import SCORED_SCHEMA
from tidewatch.session import remove, streaming_session, work_dir
from tidewatch.sinks import messages as message_sink
from tidewatch.sinks import tables
from tidewatch.sources import events
from tidewatch.sources.cities import lookup_city
from tidewatch.sources.messages import file_stream, project_records
from tidewatch.sources.progress import offset_log
from tidewatch.sources.tables import (
    last_rows,
    load_batches,
    load_bursts,
    load_late,
    load_recorded,
    load_results,
    read_parquet_dir,
)
from tidewatch.streaming import pipeline

TABLE_RULES = RuleConfig(
    amount_limit=150.0,
    rapid_limit=2,
    rapid_window_seconds=6 * 3600,
    rapid_slide_seconds=3 * 3600,
    distance_limit_km=500.0,
    rules=RULES,
)
DEFAULT_SET = replace(TABLE_RULES, rules=("high_value", "location_anomaly"))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def _km(column: str) -> Column:
    """Trigonometry may differ between engines in the last digit."""
    return F.round(column, 6).alias(column)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events.to_messages(events.transactions(spark, sf_dir))
    return messages.parse_transactions(project_records(raw))


def damage(txns: DataFrame) -> DataFrame:
    """Messages of which some cannot be scored, one defect per merchant.

    Defects: no message (7), cut-off JSON (17), text amount (27), bad time (37),
    no user (47), NaN amount (57), no id (67), dated a day ahead (77). The other
    merchants are sound.
    """
    value = messages.message_value(txns)

    def merchant(k: int) -> Column:
        return F.col("merchant") == f"merchant_{k}"

    def replaced(pattern: str, text: str) -> Column:
        return F.regexp_replace(value, pattern, text)

    broken = (
        F.when(merchant(7), F.lit(None).cast("string"))
        .when(merchant(17), F.lit('{"transaction_id'))
        .when(merchant(27), replaced(r'"amount":[^,]*', '"amount":"oops"'))
        .when(merchant(37), replaced(r'"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .when(merchant(47), replaced(r'"user_id":"[^"]*"', '"user_id":null'))
        .when(merchant(57), replaced(r'"amount":[^,]*', '"amount":NaN'))
        .when(merchant(67), replaced(r'"transaction_id":"[^"]*",', ""))
        .otherwise(value)
    )
    sent = F.col("event_time").cast("timestamp")
    early = F.when(merchant(77), sent - F.expr("interval 1 day")).otherwise(sent)
    return txns.select(broken.cast("binary").alias("value"), early.alias("timestamp"))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = damage(events.transactions(spark, sf_dir))
    return messages.parse_transactions(project_records(raw))


def _scored(spark: SparkSession, sf_dir: str, config: RuleConfig = TABLE_RULES) -> DataFrame:
    return scoring.score_transactions(events.transactions(spark, sf_dir), config)


def _stored(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Scored messages as the result tables hold them, at rest below ``out``."""
    raw = events.to_messages(events.transactions(spark, sf_dir))
    return score_landed(land_messages(raw, out, 0), DEFAULT_SET, out, 0)


# --- sources ---------------------------------------------------------------


@query
def src_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of JSON messages, read to its end."""
    out = work_dir(spark, "src_stream")
    stream = events.stream_events(streaming_session(spark), sf_dir)
    raw = events.to_messages(events.to_transactions(stream))
    parsed = messages.parse_transactions(project_records(raw)).drop("event_time")
    (
        parsed.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _plain_times(spark.read.schema(parsed.schema).parquet(f"{out}/rows"))


@query
def src_record_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events.read_events(spark, sf_dir).select(
        F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp")
    )
    return project_records(raw)


@query
def src_parquet_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's folder, or file, with whatever files it has."""
    path = events.events_path(sf_dir)
    return read_parquet_dir(spark, path, events.EVENTS_SCHEMA)


@query
def src_load_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both result tables of a bulk run."""
    out = work_dir(spark, "src_load_results")
    raw = events.to_messages(events.transactions(spark, sf_dir))
    backfill(raw, TABLE_RULES, out, 0)
    clean, alerts = load_results(spark, out)
    named = [
        df.select(
            "transaction_id",
            "amount",
            "fraud_rapid_fire",
            "is_fraud",
            "batch_id",
            F.lit(name).alias("table_name"),
        )
        for df, name in ((clean, "transactions"), (alerts, "fraud_alerts"))
    ]
    return named[0].unionByName(named[1])


@query
def dim_city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = events.transactions(spark, sf_dir).select("transaction_id", "city")
    return lookup_city(txns).select("transaction_id", "city", "city_latitude", "city_longitude")


# --- parsing ---------------------------------------------------------------


@query
def parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(_parsed(spark, sf_dir))


@query
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable times become NULL; so do those of unreadable messages."""
    damaged = _damaged(spark, sf_dir)
    return _plain_times(damaged.select("kafka_ts", "timestamp", "event_time"))


@query
def sink_json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message text; coordinates to 6 digits, which print alike everywhere."""
    txns = events.transactions(spark, sf_dir).withColumns(
        {c: F.round(c, 6) for c in ("latitude", "longitude")}
    )
    return message_sink.to_values(txns)


# --- rules -----------------------------------------------------------------


@query
def rule_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = events.transactions(spark, sf_dir).select("transaction_id", "user_id", "amount")
    return rules.flag_high_value(txns, TABLE_RULES)


@query
def rapid_fire_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rapid_fire.hot_windows(events.transactions(spark, sf_dir), TABLE_RULES)


@query
def rapid_fire_user_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = rapid_fire.flag_users(events.transactions(spark, sf_dir), TABLE_RULES)
    return flagged.select("transaction_id", "user_id", "fraud_rapid_fire")


@query
def rule_rapid_fire(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = rapid_fire.flag_rows(events.transactions(spark, sf_dir), TABLE_RULES)
    return flagged.select("transaction_id", "user_id", "event_time", "fraud_rapid_fire")


@query
def prev_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.previous_location(events.transactions(spark, sf_dir), TABLE_RULES)
    return rows.select("transaction_id", "user_id", "event_time", "prev_lat", "prev_lon")


@query
def haversine_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the centre of a transaction's city to where it was made."""
    rows = lookup_city(events.transactions(spark, sf_dir))
    distance = haversine_km(
        F.col("city_latitude"), F.col("city_longitude"), F.col("latitude"), F.col("longitude")
    )
    return rows.select("transaction_id", F.round(distance, 6).alias("distance_km"))


@query
def rule_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.flag_location(events.transactions(spark, sf_dir), TABLE_RULES)
    return rows.select("transaction_id", "user_id", _km("distance_km"), "fraud_location_anomaly")


@query
def fill_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL amounts (from damaged messages) leave no NULL flag behind."""
    flagged = rules.flag_high_value(_damaged(spark, sf_dir), TABLE_RULES)
    filled = flags.fill_flags(flagged, ["fraud_high_value"])
    return _plain_times(filled.select("kafka_ts", "amount", "fraud_high_value"))


@query
def combine_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, DEFAULT_SET)
    both = F.col("fraud_high_value") & F.col("fraud_location_anomaly")
    return scored.select(
        "transaction_id", "is_fraud", both.alias("both_rules"), (~F.col("is_fraud")).alias("clean")
    )


@query
def label_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, DEFAULT_SET)
    return scored.select("transaction_id", "fraud_reason")


@query
def score_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(
        "transaction_id",
        "user_id",
        "amount",
        "event_time",
        "fraud_high_value",
        "fraud_rapid_fire",
        _km("distance_km"),
        "fraud_location_anomaly",
        "is_fraud",
        "fraud_reason",
    )


@query
def route_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = routing.clean_rows(_scored(spark, sf_dir))
    return clean.select("transaction_id", "user_id", "amount", "is_fraud")


@query
def route_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = routing.alert_rows(_scored(spark, sf_dir))
    return alerts.select("transaction_id", "user_id", "amount", "is_fraud", "fraud_reason")


@query
def route_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = validate.rejected_rows(_damaged(spark, sf_dir))
    return _plain_times(rejects.select("kafka_ts", "transaction_id", "user_id", "reject_reason"))


@query
def union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of different width: columns missing on one side are NULL there."""
    scored = _scored(spark, sf_dir, DEFAULT_SET)
    clean = routing.clean_rows(scored).select("transaction_id", "amount", "is_fraud")
    alerts = routing.alert_rows(scored).select("transaction_id", "amount", "fraud_reason")
    return reports.union_results(clean, alerts)


# --- sinks -----------------------------------------------------------------


@query
def sink_clean_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "sink_clean_parquet")
    tables.write_clean(_stored(spark, sf_dir, out), out, 0)
    back = read_parquet_dir(spark, f"{out}/transactions", SCORED_SCHEMA)
    return _plain_times(
        back.select("transaction_id", "user_id", "amount", "event_time", "is_fraud")
    )


@query
def sink_alert_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "sink_alert_parquet")
    tables.write_alerts(_stored(spark, sf_dir, out), out, 0)
    back = read_parquet_dir(spark, f"{out}/fraud_alerts", SCORED_SCHEMA)
    return _plain_times(
        back.select(
            "transaction_id",
            "user_id",
            "amount",
            "event_time",
            _km("distance_km"),
            "is_fraud",
            "fraud_reason",
        )
    )


@query
def sink_alert_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "sink_alert_csv")
    tables.write_alerts_csv(_stored(spark, sf_dir, out), out, 0)
    back = tables.read_alerts_csv(spark, f"{out}/fraud_alerts_csv/batch_id=0")
    return _plain_times(back.drop("processed_at"))


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.batch_metrics(_scored(spark, sf_dir, DEFAULT_SET))


# --- streaming -------------------------------------------------------------


STEPS, FILES_PER_STEP = 5, 2
#: A step keeps its few files, by which a micro-batch is cut; many row groups let many tasks read them.
ROW_GROUP_BYTES = 1 << 20
#: These events reach the stream in its last step, long after their time.
LATE_EVENTS = "event_id % 50 = 7"


def _write_step(part: DataFrame, path: str, files: int = FILES_PER_STEP) -> None:
    part.repartition(files).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def _in_steps(spark: SparkSession, sf_dir: str, out: str, late: bool = False) -> DataFrame:
    """The table as a stream of messages that comes in steps, each a micro-batch.

    A step is a fifth of the time that the table spans. Files are taken by age, so
    the steps are written one after the other.
    """
    table = events.read_events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = table.agg(F.min(micros), F.max(micros)).first()
    first, last = first or 0, last or 0
    step = F.floor((micros - first) * STEPS / (last - first + 1)).cast("int")
    if late:
        step = F.when(F.expr(LATE_EVENTS), F.lit(STEPS - 1)).otherwise(step)
    for i in range(STEPS):
        _write_step(table.filter(step == i), f"{out}/inbox/step-{i}")
    stream = file_stream(
        streaming_session(spark), f"{out}/inbox/*", events.EVENTS_SCHEMA, "parquet", FILES_PER_STEP
    )
    return events.to_messages(events.to_transactions(stream))


#: How long a row may be on its way, and how long the stream waits for it.
TRAVEL_SECONDS, PATIENCE, PANE_SECONDS = 12 * 3600, "1 day", 3600
CLOCK = -1  # the user of the last row, which moves the watermark past all others


def _out_of_order(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The table in steps by time of arrival: up to half a day after the time of a row.

    The late events come in the last step, long after their time; then one row by the clock.
    """
    table = events.read_events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = table.agg(F.min(micros), F.max(micros)).first()
    first, last = first or 0, last or 0
    arrival = micros + F.pmod(F.col("event_id") * 7919, F.lit(TRAVEL_SECONDS)) * 1_000_000
    span = last - first + 1 + TRAVEL_SECONDS * 1_000_000
    step = F.floor((arrival - first) * STEPS / span).cast("int")
    step = F.when(F.expr(LATE_EVENTS), F.lit(STEPS - 1)).otherwise(step)
    end = F.timestamp_micros(F.lit(last + 10 * 86_400 * 1_000_000)).cast("timestamp_ntz")
    clock = spark.range(1).select(
        F.lit(CLOCK).cast("long").alias("event_id"),
        end.alias("ts"),
        F.lit(CLOCK).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": 0}').alias("props"),
    )
    parts = [table.filter(step == i) for i in range(STEPS)] + [clock]
    for i, part in enumerate(parts):
        _write_step(part, f"{out}/inbox/step-{i}", FILES_PER_STEP if i < STEPS else 1)
    stream = file_stream(
        streaming_session(spark), f"{out}/inbox/*", events.EVENTS_SCHEMA, "parquet", FILES_PER_STEP
    )
    return events.to_messages(events.to_transactions(stream))


def _run_scoring(raw: DataFrame, out: str) -> None:
    config = StreamConfig(output_path=out)
    pipeline.start_scoring(raw, DEFAULT_SET, config, available_now=True).awaitTermination()


@query
def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables as the scoring stream leaves them."""
    out = work_dir(spark, "stream_foreach_batch")
    _run_scoring(_in_steps(spark, sf_dir, out), out)
    results = reports.union_results(*load_results(spark, out))
    return _plain_times(
        results.select(
            "transaction_id",
            "user_id",
            "amount",
            "kafka_ts",
            "event_time",
            "fraud_high_value",
            _km("distance_km"),
            "fraud_location_anomaly",
            "is_fraud",
            "fraud_reason",
        )
    )


@query
def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was written but not committed is replayed when the query restarts.

    It finds the state as it was before the batch, and each row is there once.
    """
    out = work_dir(spark, "stream_recovery")
    raw = _in_steps(spark, sf_dir, out)
    _run_scoring(raw, out)
    commits = f"{out}/_checkpoints/main/commits"
    for name in (str(STEPS - 1), f".{STEPS - 1}.crc"):
        remove(spark, f"{commits}/{name}")
    _run_scoring(raw, out)
    results = reports.union_results(*load_results(spark, out))
    return results.groupBy("is_fraud", "fraud_reason").agg(
        F.count("*").alias("rows"), F.countDistinct("transaction_id").alias("transactions")
    )


@query
def stream_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous location and distance, from state kept between five micro-batches."""
    out = work_dir(spark, "stream_location")
    columns = ["transaction_id", "user_id", "prev_lat", "prev_lon", "out_of_order"]
    columns += ["distance_km", "fraud_location_anomaly"]
    config = replace(TABLE_RULES, rules=("location_anomaly",))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        located = pipeline.score_batch(batch, config).select(*columns)
        located.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        batch.unpersist()

    raw = _in_steps(spark, sf_dir, out)
    (
        pipeline.parse_stream(raw, config)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows").select(*columns[:5], _km(columns[5]), columns[6])


@query
def stream_location_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive out of order, scored in time order; those behind the watermark as late."""
    out = work_dir(spark, "stream_location_late")
    config = StreamConfig(output_path=out, ordered=True, watermark=PATIENCE, pane_seconds=PANE_SECONDS)
    raw = _out_of_order(spark, sf_dir, out)
    pipeline.start_scoring(raw, DEFAULT_SET, config, available_now=True).awaitTermination()
    results = reports.union_results(*load_results(spark, out)).filter(F.col("user_id") != str(CLOCK))
    late = load_late(spark, out).select("transaction_id", F.lit(True).alias("late"))
    return results.join(late, "transaction_id", "left").select(
        "transaction_id",
        "user_id",
        "prev_lat",
        "prev_lon",
        "out_of_order",
        F.coalesce("late", F.lit(False)).alias("late"),
        _km("distance_km"),
        "fraud_location_anomaly",
    )


#: The batch id of a bulk load: one that no stream reaches.
BULK_ID = 1_000_000_000


@query
def stream_after_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fifths of the time in bulk, the rest as a stream that knows the users of the bulk."""
    out = work_dir(spark, "stream_after_backfill")
    raw = _in_steps(spark, sf_dir, out)
    earlier = [f"{out}/inbox/step-{i}" for i in range(3)]
    bulk = spark.read.schema(events.EVENTS_SCHEMA).parquet(*earlier)
    backfill(events.to_messages(events.to_transactions(bulk)), DEFAULT_SET, out, BULK_ID)
    later = file_stream(
        raw.sparkSession, f"{out}/inbox/step-[34]", events.EVENTS_SCHEMA, "parquet", FILES_PER_STEP
    )
    pipeline.start_scoring(
        events.to_messages(events.to_transactions(later)),
        DEFAULT_SET,
        StreamConfig(output_path=out),
        available_now=True,
        known=last_rows(raw.sparkSession, out),
    ).awaitTermination()
    results = reports.union_results(*load_results(spark, out))
    return _plain_times(
        results.select(
            "transaction_id",
            "user_id",
            "amount",
            "kafka_ts",
            "event_time",
            "fraud_high_value",
            _km("distance_km"),
            "fraud_location_anomaly",
            "is_fraud",
            "fraud_reason",
        )
    )


@query
def stream_rapid_fire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot windows that the watermark has closed; late rows count only in open windows."""
    out = work_dir(spark, "stream_rapid_fire")
    raw = _in_steps(spark, sf_dir, out, late=True)
    config = StreamConfig(output_path=out)
    pipeline.start_rapid_fire(raw, TABLE_RULES, config, available_now=True).awaitTermination()
    return _plain_times(load_bursts(spark, out))


@query
def stream_rapid_fire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the scoring stream with the bursts of the burst stream beside it."""
    out = work_dir(spark, "stream_rapid_fire_rows")
    raw = _in_steps(spark, sf_dir, out)
    _run_scoring(raw, out)
    config = StreamConfig(output_path=out)
    pipeline.start_rapid_fire(raw, TABLE_RULES, config, available_now=True).awaitTermination()
    results = reports.stored_results(spark, out, TABLE_RULES)
    flags = ["fraud_high_value", "fraud_rapid_fire", "fraud_location_anomaly"]
    return results.select("transaction_id", "user_id", *flags, "is_fraud", "fraud_reason")


@query
def stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the scoring stream, merged with the corrections that a stream beside it made."""
    out = work_dir(spark, "stream_corrections")
    raw = _in_steps(spark, sf_dir, out)
    _run_scoring(raw, out)
    config = StreamConfig(output_path=out)
    pipeline.start_corrections(raw, TABLE_RULES, config, available_now=True).awaitTermination()
    results = reports.corrected_results(spark, out)
    flags = ["fraud_high_value", "fraud_rapid_fire", "fraud_location_anomaly"]
    return results.select("transaction_id", "user_id", *flags, "is_fraud", "fraud_reason")


@query
def stream_batch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts recorded with each batch, and the rows of the tables that a reader of whole batches sees."""
    out = work_dir(spark, "stream_batch_records")
    config = StreamConfig(output_path=out, batch_records=True)
    raw = _in_steps(spark, sf_dir, out)
    pipeline.start_scoring(raw, DEFAULT_SET, config, available_now=True).awaitTermination()
    rows = reports.union_results(*load_recorded(spark, out)).groupBy("batch_id").agg(F.count("*").alias("rows"))
    told = load_batches(spark, out).join(rows, "batch_id", "left")
    return told.select("batch_id", "total", "alerts", "rejects", F.round("alert_rate", 6).alias("alert_rate"), "rows")


@query
def stream_offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checkpoint says of each batch of the scoring stream, beside the rows stored by it."""
    out = work_dir(spark, "stream_offset_audit")
    _run_scoring(_in_steps(spark, sf_dir, out), out)
    log = offset_log(spark, f"{out}/_checkpoints/main").filter("source = 0")
    rows = reports.union_results(*load_results(spark, out)).groupBy("batch_id").agg(F.count("*").alias("rows"))
    told = audit_offsets(log).filter("verdict != 'idle'")  # a batch without new files closes windows
    return told.join(rows, "batch_id", "left").select(
        "batch_id", "verdict", "missing_batches", "replays", F.coalesce("rows", F.lit(0)).alias("rows")
    )


@query
def rapid_fire_burst_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with each hot window around it, from counts by pane."""
    return rapid_fire.burst_rows(events.transactions(spark, sf_dir), TABLE_RULES)


# --- reports ---------------------------------------------------------------


@query
def report_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of doubles depend on the order of addition in the last digits."""
    kpis = reports.kpis(_scored(spark, sf_dir, DEFAULT_SET))
    rounded = {c: F.round(c, 6) for c in ("alert_rate", "avg_alert_amount")}
    return kpis.withColumns(rounded)


@query
def report_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_alerts(_scored(spark, sf_dir))


@query
def report_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reason_counts(_scored(spark, sf_dir))


@query
def report_volume_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(reports.volume_by_minute(_scored(spark, sf_dir)))


@query
def stream_partial_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports as a refresh merges them from the partial sums of a stream's batches.

    One row per figure: the report, what the figure is of, and the figure.
    """
    out = work_dir(spark, "stream_partial_reports")
    raw = _in_steps(spark, sf_dir, out)
    config = StreamConfig(output_path=out, partial_reports=True)
    pipeline.start_scoring(raw, DEFAULT_SET, config, available_now=True).awaitTermination()
    found = partials.refresh(spark, out)

    def figures(report: str, key: Column, value: str) -> DataFrame:
        of, figure = key.cast("string"), F.round(F.col(value).cast("double"), 6)
        return found[report].select(F.lit(report).alias("report"), of.alias("of"), figure.alias("figure"))

    minute = F.concat_ws(" ", F.date_format("minute", "yyyy-MM-dd HH:mm"), F.col("is_fraud").cast("string"))
    cell = F.concat_ws(" ", F.col("south").cast("int").cast("string"), F.col("west").cast("int").cast("string"))
    parts = [figures("kpis", F.lit(c), c) for c in found["kpis"].columns]
    parts += [
        figures("reason_counts", F.col("reason"), "alerts"),
        figures("volume_by_minute", minute, "rows"),
        figures("geo_grid", cell, "alerts"),
        figures("latest_alerts", F.col("transaction_id"), "amount"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def report_geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.geo_points(_scored(spark, sf_dir))


@query
def report_geo_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = reports.geo_grid(_scored(spark, sf_dir))
    return grid.withColumn("amount", F.round("amount", 2))
