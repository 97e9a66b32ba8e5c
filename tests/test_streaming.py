import json
import time
from dataclasses import replace
from datetime import timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from support import FAR, HOME, START, SMALL
from tidewatch.config import RuleConfig, StreamConfig
from tidewatch.plans import reports
from tidewatch.plans.scoring import score_transactions
from tidewatch.session import streaming_session
from tidewatch.sources import events
from tidewatch.sources.messages import file_stream, project_records, text_stream
from tidewatch.sources.tables import load_results
from tidewatch.streaming import pipeline
from tidewatch.streaming.last_seen import FIELDS, newest_per_user

LIVE = RuleConfig()


class Feed:
    """A folder of message files, one micro-batch each, and its scoring query."""

    def __init__(self, spark, path: Path):
        self.spark, self.session = spark, streaming_session(spark)
        self.inbox, self.out, self.files = path / "inbox", path / "out", 0
        self.inbox.mkdir()
        self.stream = StreamConfig(output_path=str(self.out))
        self.metrics = []

    def send(self, *rows):
        """Rows are (id, user, seconds after START, place[, amount]) or raw text."""
        lines = [row if isinstance(row, str) else self.message(*row) for row in rows]
        name = self.inbox / f"{self.files:03d}.txt"
        name.write_text("".join(line + "\n" for line in lines))
        # Files are taken oldest first.
        import os

        os.utime(name, (1_900_000_000 + self.files, 1_900_000_000 + self.files))
        self.files += 1

    @staticmethod
    def message(tid, user, second, place=HOME, amount=10.0):
        time = (START + timedelta(seconds=second)).isoformat() + "+00:00"
        return json.dumps(
            {
                "transaction_id": tid,
                "user_id": user,
                "amount": amount,
                "timestamp": time,
                "city": "Paris",
                "latitude": place[0],
                "longitude": place[1],
                "transaction_type": "purchase",
                "merchant": "m",
                "is_seed_fraud": None,
            }
        )

    def messages(self):
        return text_stream(self.session, str(self.inbox), max_files=1)

    def score(self, rules=LIVE):
        query = pipeline.start_scoring(
            self.messages(), rules, self.stream, available_now=True, on_metrics=self.metrics.append
        )
        query.awaitTermination()

    def watch(self, rules, early=False):
        query = pipeline.start_rapid_fire(
            self.messages(), rules, self.stream, early=early, available_now=True
        )
        query.awaitTermination()
        path = self.out / ("rapid_fire_early" if early else "rapid_fire_alerts")
        rows = self.spark.read.schema(
            "user_id string, window_start timestamp, window_end timestamp, txn_count bigint"
        ).parquet(str(path))
        return {
            (r.user_id, (r.window_start - START).total_seconds(), r.txn_count)
            for r in rows.collect()
        }

    def wait_for(self, rows, seconds=60):
        end = time.monotonic() + seconds
        while self.results().count() < rows and time.monotonic() < end:
            time.sleep(0.5)

    def results(self):
        return reports.union_results(*load_results(self.spark, str(self.out)))

    def found(self, *columns):
        return {r.transaction_id: tuple(r[c] for c in columns) for r in self.results().collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_history_survives_between_batches(feed):
    feed.send(("a", "u", 0, HOME), ("x", "v", 0, HOME))
    feed.send(("b", "u", 60, FAR))
    feed.send(("c", "u", 120, FAR), ("d", "u", 121, HOME), ("y", "v", 120, HOME))
    feed.score()
    assert feed.found("prev_lat", "fraud_location_anomaly") == {
        "a": (None, False),
        "b": (HOME[0], True),
        "c": (FAR[0], False),
        "d": (FAR[0], True),
        "x": (None, False),
        "y": (HOME[0], False),
    }
    assert [(m.total, m.alerts) for m in feed.metrics] == [(2, 0), (1, 1), (3, 1)]


def test_a_restarted_query_goes_on(feed):
    feed.send(("a", "u", 0, HOME))
    feed.score()
    feed.send(("b", "u", 60, FAR))
    feed.score()
    assert feed.found("prev_lat") == {"a": (None,), "b": (HOME[0],)}


@pytest.mark.parametrize("segment_rows", [1_000_000, 10])
def test_batch_and_stream_agree(spark, tmp_path, segment_rows):
    """The same rows as one batch and as five micro-batches, users split or not."""
    table = events.read_events(spark, SMALL)
    source = str(tmp_path / "events")
    for part in range(5):
        # Event ids follow event time.
        table.filter(F.floor(F.col("event_id") / 200) == part).coalesce(1).write.mode(
            "append"
        ).parquet(source)
    rules = RuleConfig(amount_limit=150.0, segment_rows=segment_rows)
    stream = file_stream(
        streaming_session(spark), source, events.EVENTS_SCHEMA, "parquet", max_files=1
    )
    raw = events.to_messages(events.to_transactions(stream))
    metrics = []
    config = StreamConfig(output_path=str(tmp_path / "out"))
    pipeline.start_scoring(
        raw, rules, config, available_now=True, on_metrics=metrics.append
    ).awaitTermination()
    assert [m.total for m in metrics] == [200] * 5
    columns = ["transaction_id", "prev_lat", "prev_lon", "distance_km", "is_fraud", "fraud_reason"]
    streamed = reports.union_results(*load_results(spark, str(tmp_path / "out"))).select(columns)
    batch = score_transactions(events.transactions(spark, SMALL), rules).select(columns)
    assert streamed.count() == batch.count() == 1000
    assert streamed.exceptAll(batch).isEmpty()


def test_an_uncommitted_batch_is_replayed_without_effect(feed):
    feed.send(("a", "u", 0, HOME))
    feed.send(("b", "u", 60, FAR))
    feed.score()
    columns = ("prev_lat", "distance_km", "fraud_reason")
    before = feed.found(*columns)
    for name in ("1", ".1.crc"):
        (feed.out / "_checkpoints" / "main" / "commits" / name).unlink(missing_ok=True)
    feed.score()
    assert len(feed.metrics) == 3 and feed.metrics[1] == feed.metrics[2]
    assert feed.results().count() == 2
    assert feed.found(*columns) == before
    feed.send(("c", "u", 120, HOME))
    feed.score()
    assert feed.found("prev_lat")["c"] == (FAR[0],)


def test_out_of_order_rows_are_marked_not_flagged(feed):
    feed.send(("b", "u", 60, HOME))
    feed.send(("a", "u", 30, FAR), ("c", "u", 90, HOME))
    feed.send(("d", "u", 95, FAR))
    feed.score()
    found = feed.found("prev_lat", "fraud_location_anomaly")
    assert found["a"] == (None, False)
    assert found["c"] == (HOME[0], False)
    assert found["d"] == (HOME[0], True)
    late = feed.spark.read.parquet(f"{feed.out}/transactions").filter("out_of_order").collect()
    assert [r.transaction_id for r in late] == ["a"]
    assert [m.out_of_order for m in feed.metrics] == [0, 1, 0]


def test_ties_across_batches_follow_the_id(feed):
    feed.send(("b", "u", 0, HOME))
    feed.send(("a", "u", 0, FAR), ("c", "u", 0, FAR))
    feed.score()
    assert feed.found("prev_lat") == {"a": (None,), "b": (None,), "c": (HOME[0],)}


def test_users_unseen_for_long_are_forgotten(feed):
    feed.stream = replace(feed.stream, state_ttl_seconds=1, trigger="1 second")
    with pytest.raises(ValueError, match="never runs out"):
        feed.score()
    feed.send(("a", "u", 0, HOME))
    query = pipeline.start_scoring(feed.messages(), LIVE, feed.stream)
    try:
        feed.wait_for(1)
        time.sleep(6)  # batches without rows, in which the user times out
        feed.send(("b", "u", 60, FAR))
        feed.wait_for(2)
    finally:
        query.stop()
    assert feed.found("prev_lat", "fraud_location_anomaly")["b"] == (None, False)


def test_each_chunk_gives_the_state_one_row_per_user():
    chunk = pd.DataFrame(
        [
            ("u", 5, "a", 1.0, 1.0),
            ("u", 7, "b", 2.0, 2.0),
            ("u", 7, "c", None, 3.0),
            ("v", 6, "d", 4.0, 4.0),
            ("u", 7, "c", 5.0, None),
            ("u", 1, "e", 6.0, 6.0),
        ],
        columns=["user_id", *FIELDS],
    )
    for rows in (chunk, chunk.iloc[::-1]):
        (newest,) = newest_per_user(iter([rows]))
        found = {r.user_id: (r.event_us, r.transaction_id, r.latitude) for r in newest.itertuples()}
        assert found == {"u": (7, "c", 5.0), "v": (6, "d", 4.0)}
    assert list(newest_per_user(iter([chunk.iloc[:0]])))[0].empty


def test_null_places_in_state(feed):
    feed.send(("a", "u", 0, (None, None)))
    feed.send(("b", "u", 1, FAR))
    feed.send(("c", "u", 2, HOME))
    feed.score()
    assert feed.found("prev_lat", "fraud_location_anomaly") == {
        "a": (None, False),
        "b": (None, False),
        "c": (FAR[0], True),
    }


def test_rejects_are_kept_with_reason_and_message(feed):
    nobody = Feed.message("t", None, 0)
    unpaid = Feed.message("t2", "u", 0, amount=None)
    far_future = Feed.message("ok", "u", 0).replace("2026-", "9999-")
    feed.send("{broken", nobody, unpaid, Feed.message("big", "u", 0, HOME, 1e5), far_future)
    feed.score()
    rejects = feed.spark.read.parquet(f"{feed.out}/rejects").collect()
    assert {(r.reject_reason, r.raw_message) for r in rejects} == {
        ("malformed_message", "{broken"),
        ("missing_user_id", nobody),
        ("invalid_amount", unpaid),
        ("future_event_time", far_future),
    }
    assert set(feed.found()) == {"big"}
    assert (feed.metrics[0].total, feed.metrics[0].rejects) == (1, 4)


def test_a_far_future_row_changes_nothing_else(feed):
    burst = [(f"b{i}", "u", i) for i in range(6)]
    feed.send(Feed.message("odd", "u", 0, FAR).replace("2026-", "9999-"))
    feed.send(*burst)
    feed.send(("jump", "u", 3600, FAR))
    feed.send(("next", "v", 3601))
    feed.score()
    assert feed.found("prev_lat", "fraud_location_anomaly")["jump"] == (HOME[0], True)
    assert feed.watch(LIVE) == {("u", -30.0, 6), ("u", 0.0, 6)}


def test_an_empty_batch_writes_nothing(feed):
    feed.send()
    feed.score()
    assert feed.metrics == [] and not (feed.out / "transactions").exists()


def test_stateless_rules_need_no_state(feed):
    feed.send(("a", "u", 0, HOME, 99_999.0))
    feed.score(replace(LIVE, rules=("high_value",)))
    alerts = feed.spark.read.parquet(f"{feed.out}/fraud_alerts")
    assert [r.fraud_reason for r in alerts.collect()] == ["high_value"]
    assert not (feed.out / "_checkpoints" / "main" / "state").exists()


def test_bursts_are_not_scored_per_batch(feed):
    with pytest.raises(ValueError, match="start_rapid_fire"):
        feed.score(replace(LIVE, rules=("high_value", "rapid_fire")))


def test_hot_windows_count_across_batches_and_ignore_late_rows(feed):
    burst = [(f"b{i}", "u", i) for i in range(6)]
    feed.send(*burst[:3])
    feed.send(*burst[3:])
    # Moves the watermark past the burst's windows; the next batch closes them.
    feed.send(("later", "v", 3600))
    feed.send(("next", "v", 3601))
    # Too late: would make a seventh row in closed windows.
    feed.send(("late", "u", 3), ("end", "v", 7200))
    assert feed.watch(LIVE) == {("u", -30.0, 6), ("u", 0.0, 6)}


def test_reports_see_closed_bursts(feed):
    feed.send(*[(f"b{i}", "u", i) for i in range(5)])
    feed.send(("b5", "u", 31, FAR), ("b6", "u", 29), ("alone", "w", 29))
    feed.send(("later", "v", 3600), ("big", "v", 3600, HOME, 1e5))
    feed.send(("next", "v", 3601))
    feed.score()
    assert reports.refresh(feed.spark, str(feed.out))["kpis"].first().alerts == 2
    assert feed.watch(LIVE) == {("u", -30.0, 6), ("u", 0.0, 7)}
    rows = reports.stored_results(feed.spark, str(feed.out))
    assert rows.columns == feed.results().columns
    reasons = {r.transaction_id: r.fraud_reason for r in rows.collect()}
    assert reasons == {
        **{f"b{i}": "rapid_fire" for i in (0, 1, 2, 3, 4, 6)},
        "b5": "rapid_fire+location_anomaly",
        **{"alone": None, "later": None, "big": "high_value", "next": None},
    }
    shown = reports.refresh(feed.spark, str(feed.out))
    assert shown["kpis"].first().alerts == 8
    assert {r.reason: r.alerts for r in shown["reason_counts"].collect()} == {
        "rapid_fire": 6, "rapid_fire+location_anomaly": 1, "high_value": 1,
    }


def test_open_windows_are_held_back_unless_asked_for(feed):
    feed.send(*[(f"b{i}", "u", i) for i in range(6)])
    feed.send(("b6", "u", 40))
    assert feed.watch(LIVE) == set()
    early = feed.watch(LIVE, early=True)
    assert early == {("u", -30.0, 6), ("u", 0.0, 6), ("u", 0.0, 7)}


def test_a_timed_trigger_runs_until_stopped(feed):
    feed.send(("a", "u", 0, HOME))
    stream = replace(feed.stream, trigger="1 second")
    query = pipeline.start_scoring(feed.messages(), LIVE, stream)
    try:
        query.processAllAvailable()
        feed.send(("b", "u", 60, FAR))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert feed.found("prev_lat") == {"a": (None,), "b": (HOME[0],)}


def test_records_accept_text_and_binary(spark):
    df = spark.createDataFrame([("x",)], "value string").withColumn("timestamp", F.lit(None))
    assert project_records(df).first().json_str == "x"
    binary = df.withColumn("value", F.col("value").cast("binary"))
    assert project_records(binary).first().json_str == "x"
