"""Reports merged from partial sums against reports over all rows."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from support import FAR, HOME, SMALL, START
from test_streaming import LIVE, Feed
from tidewatch.config import RuleConfig
from tidewatch.plans import partials, reports
from tidewatch.plans.backfill import backfill
from tidewatch.schema import RESULT_SCHEMA, stored_columns
from tidewatch.sources import events

MERGED = ("kpis", "reason_counts", "volume_by_minute", "geo_grid", "latest_alerts")


def plain(df):
    """Rows with rounded figures; sums of doubles depend on the order of addition."""
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else str(v) for v in row) for row in df.collect()
    )


def assert_same(spark, folder, results):
    merged = partials.refresh(spark, folder)
    whole = {name: getattr(reports, name)(results) for name in MERGED}
    assert merged.keys() == whole.keys()
    for name in MERGED:
        assert merged[name].columns == whole[name].columns
        assert plain(merged[name]) == plain(whole[name]), name
    for name in ("reason_counts", "volume_by_minute", "latest_alerts"):  # their order too
        assert [str(r[0]) for r in merged[name].collect()] == [str(r[0]) for r in whole[name].collect()]


def stored(spark, number, seed):
    """Scored rows of all kinds: without place, time, amount or decision; equal rows; ties in time."""
    draw = random.Random(seed)
    rows = []
    for i in range(number):
        fraud = draw.choice([True, True, False, None])
        place = draw.choice([HOME, FAR, (-33.9, 151.2), (None, -74.0), (10.0, None), (-0.5, -0.5)])
        time = draw.choice([None, START + timedelta(seconds=draw.randrange(400))])
        reason = draw.choice(["high_value", "location_anomaly", "high_value+location_anomaly", None])
        amount = draw.choice([None, 0.0, -3.25, 1e6, draw.random() * 100])
        text = None if time is None else time.isoformat() + "+00:00"
        rows.append((f"t{seed}-{i // 2}", "u", amount, "Paris", text, time, *place, fraud, reason))
    columns = (
        "transaction_id string, user_id string, amount double, city string, timestamp string, event_time timestamp, "
        "latitude double, longitude double, is_fraud boolean, fraud_reason string"
    )
    return stored_columns(spark.createDataFrame(rows, columns))


@pytest.mark.parametrize("sizes", [(200, 3, 77, 1), (5,), (0, 12)])
def test_merged_reports_are_those_of_all_rows(spark, tmp_path, sizes):
    folder, whole = str(tmp_path), None
    for batch, size in enumerate(sizes):
        rows = stored(spark, size, batch)
        partials.write(rows, folder, batch)
        whole = rows if whole is None else whole.unionByName(rows)
    assert_same(spark, folder, whole)


def test_a_replay_replaces_its_sums(spark, tmp_path):
    rows, other = stored(spark, 60, 1), stored(spark, 40, 2)
    for batch, df in ((0, other), (1, rows), (0, rows), (1, other), (0, rows)):
        partials.write(df, str(tmp_path), batch)
    assert_same(spark, str(tmp_path), rows.unionByName(other))


def test_nothing_written_yet(spark, tmp_path):
    assert_same(spark, str(tmp_path / "none"), spark.createDataFrame([], RESULT_SCHEMA))


def test_a_refresh_of_a_stream_reads_partial_sums_alone(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.stream = replace(feed.stream, partial_reports=True)
    feed.send(("a", "u", 0, HOME), ("x", "v", 0, HOME, 1e5))
    feed.send(("b", "u", 60, FAR), "no message")
    feed.score()
    feed.send(("c", "u", 120, HOME), ("y", "v", 120, HOME, 2e5))
    feed.score()
    merged = partials.refresh(spark, str(feed.out))
    assert merged["kpis"].first().alerts == 4
    assert_same(spark, str(feed.out), feed.results())
    for report in merged.values():
        files = report.inputFiles()
        assert files and all("/report_counts/" in f or "/report_newest/" in f for f in files)


def test_a_bulk_load_and_a_stream_add_up(spark, tmp_path):
    raw = events.to_messages(events.transactions(spark, SMALL))
    rules = RuleConfig(amount_limit=150.0)
    feed = Feed(spark, tmp_path)
    feed.stream = replace(feed.stream, partial_reports=True)
    backfill(raw, rules, str(feed.out), 1_000_000, partial_reports=True)
    feed.send(("a", "new", 0, HOME), ("b", "new", 60, FAR))
    feed.score(LIVE)
    assert feed.results().count() == raw.count() + 2
    assert_same(spark, str(feed.out), feed.results())


def test_sums_are_few(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("u").alias("user_id"), F.lit(1.0).alias("amount"),
        F.lit("Paris").alias("city"), (F.lit(START) + F.expr("make_interval(0,0,0,0,0,0,id % 240)")).alias("event_time"),
        F.lit(None).cast("string").alias("timestamp"), F.lit(40.0).alias("latitude"), F.lit(-74.5).alias("longitude"),
        (F.col("id") % 10 == 0).alias("is_fraud"), F.lit(None).cast("string").alias("fraud_reason"),
    )
    assert partials.counts(rows).count() == 8 and partials.newest(rows).count() == reports.LATEST_ROWS
