"""Streams in time order: late rows, restarts, and going on from stored tables."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from support import FAR, HOME, SMALL
from test_streaming import LIVE, Feed
from tidewatch.config import RuleConfig, StreamConfig
from tidewatch.plans import reports
from tidewatch.plans.backfill import backfill
from tidewatch.plans.scoring import score_transactions
from tidewatch.schema import LATE_SCHEMA
from tidewatch.session import streaming_session
from tidewatch.sources import events
from tidewatch.sources.tables import last_rows, load_results
from tidewatch.streaming import pipeline

CLOCK = "clock"  # a user whose rows only move the watermark


@pytest.fixture
def feed(spark, tmp_path):
    found = Feed(spark, tmp_path)
    found.stream = replace(found.stream, ordered=True)
    return found


def late(feed):
    rows = feed.spark.read.schema(LATE_SCHEMA).parquet(f"{feed.out}/late_rows").collect()
    return {r.transaction_id: r.late_by for r in rows}


def test_rows_wait_for_the_watermark_and_are_scored_in_order(feed):
    feed.send(("b", "u", 60, FAR), ("d", "u", 200, HOME))
    feed.send(("a", "u", 5, HOME), ("c", "u", 100, FAR))
    feed.send(("t", CLOCK, 2_000))
    feed.score()
    assert feed.found("prev_lat", "fraud_location_anomaly", "out_of_order") == {
        "a": (None, False, False),
        "b": (HOME[0], True, False),
        "c": (FAR[0], False, False),
        "d": (FAR[0], True, False),
    }
    assert late(feed) == {}


def test_open_panes_stay_in_state_across_a_restart(feed):
    feed.send(("b", "u", 60, FAR))
    feed.score()
    assert feed.files == 1 and not (feed.out / "transactions").exists()
    feed.send(("a", "u", 30, HOME))
    feed.score()
    feed.send(("t", CLOCK, 2_000))
    feed.score()
    assert feed.found("prev_lat") == {"a": (None,), "b": (HOME[0],)}


def test_rows_behind_the_watermark_are_marked_and_listed(feed):
    feed.send(("b", "u", 900, FAR), ("t", CLOCK, 3_000))
    feed.send(("t1", CLOCK, 3_000))  # this batch releases b
    feed.send(("a", "u", 60, HOME), ("c", "u", 2_500, HOME))
    feed.send(("t2", CLOCK, 6_000))
    feed.score()
    found = feed.found("prev_lat", "fraud_location_anomaly", "out_of_order")
    assert found["a"] == (None, False, True)
    assert found["c"] == (FAR[0], True, False)
    assert late(feed) == {"a": pytest.approx(3_000 - 600 - 60, abs=0.01)}
    # Every row once: on time or late (the clock's last row waits).
    assert set(found) == {"a", "b", "c", "t", "t1"}


def test_rejects_do_not_wait(feed):
    feed.send("{broken", ("a", "u", 0))
    feed.score()
    assert feed.spark.read.parquet(f"{feed.out}/rejects").count() == 1
    assert not (feed.out / "transactions").exists() or feed.results().count() == 0


def test_the_order_of_columns_and_values_survives_the_wait(feed):
    odd = Feed.message("a", "u", 0, (float("nan"), None), 0.1 + 0.2)
    feed.send(odd, ("t", CLOCK, 2_000))
    feed.score()
    (row,) = feed.results().collect()
    assert row.amount == 0.1 + 0.2 and row.longitude is None
    assert row.event_time.isoformat() == "2026-03-01T12:00:00" and row.kafka_ts is not None


def test_a_shuffled_feed_gives_the_rows_of_the_batch(spark, tmp_path):
    """Events dealt to files at random within the watermark, and a clock row at the end."""
    feed = Feed(spark, tmp_path)
    feed.stream = replace(feed.stream, ordered=True, watermark="2 hours", pane_seconds=600)
    draw = random.Random(4)
    places = [HOME, FAR, (48.8, 2.3), (None, None)]
    rows = [
        (f"t{i:03d}", f"u{draw.randint(0, 4)}", draw.randint(0, 86_400), draw.choice(places))
        for i in range(300)
    ]
    # A row arrives up to 100 minutes after its time: always within the watermark.
    arrivals = sorted(rows, key=lambda r: r[2] + draw.randint(0, 6_000))
    for part in range(6):
        feed.send(*arrivals[part * 50 : part * 50 + 50])
    feed.send(("clock", CLOCK, 100_000))
    feed.score()
    assert late(feed) == {}
    raw = spark.read.text(str(feed.inbox)).select("value", F.lit(None).cast("timestamp").alias("timestamp"))
    backfill(raw, LIVE, str(tmp_path / "bulk"), 0)
    columns = ["transaction_id", "prev_lat", "prev_lon", "distance_km", "is_fraud", "fraud_reason"]
    batch = reports.union_results(*load_results(spark, str(tmp_path / "bulk"))).select(columns)
    batch = batch.filter(f"transaction_id != '{CLOCK}'")
    streamed = feed.results().select(columns)
    assert streamed.count() == batch.count() == 300
    assert streamed.exceptAll(batch).isEmpty()


@pytest.mark.parametrize("ordered", [False, True])
def test_a_stream_goes_on_from_stored_tables(spark, tmp_path, ordered):
    out = str(tmp_path / "out")
    stream = StreamConfig(output_path=out, ordered=ordered, watermark="1 hour", pane_seconds=3600)
    rules = RuleConfig(amount_limit=150.0)
    txns = events.transactions(spark, SMALL)
    early = F.col("transaction_id").cast("long") < 600  # ids follow time
    backfill(events.to_messages(txns.filter(early)), rules, out, 1_000)
    known = last_rows(spark, out)
    assert known.count() == txns.filter(early).select("user_id").distinct().count()
    clock = txns.limit(1).withColumns(
        {
            "transaction_id": F.lit(CLOCK),
            "user_id": F.lit(CLOCK),
            "event_time": F.lit("2030-01-01").cast("timestamp_ntz"),
            "timestamp": F.lit("2030-01-01T00:00:00+00:00"),
        }
    )
    source = str(tmp_path / "inbox")
    rest = txns.filter(~early).unionByName(clock)
    events.to_messages(rest).coalesce(1).write.parquet(source)
    session = streaming_session(spark)
    raw = session.readStream.schema("value binary, timestamp timestamp").parquet(source)
    handed = session.createDataFrame(known.collect(), known.schema)
    pipeline.start_scoring(raw, rules, stream, available_now=True, known=handed).awaitTermination()
    columns = ["transaction_id", "prev_lat", "prev_lon", "is_fraud", "fraud_reason"]
    stored = reports.union_results(*load_results(spark, out)).select(columns)
    stored = stored.filter(f"transaction_id != '{CLOCK}'")
    batch = score_transactions(txns, rules).select(columns)
    assert stored.count() == batch.count() == 1000
    assert stored.exceptAll(batch).isEmpty()


@pytest.mark.parametrize("ordered", [False, True])
def test_known_users_are_not_forgotten(feed, ordered):
    feed.stream = replace(feed.stream, state_ttl_seconds=5, ordered=ordered)
    feed.send(("a", "u", 0))
    known = feed.spark.createDataFrame([], "user_id string, event_time timestamp, transaction_id string, latitude double, longitude double")
    with pytest.raises(ValueError, match="state_ttl_seconds"):
        pipeline.parse_stream(feed.messages(), LIVE, feed.stream, known)
