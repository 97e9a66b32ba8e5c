"""Bursts that cross micro-batches: rows with their windows, and corrections of stored rows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from support import FAR, HOME, START
from test_streaming import LIVE, Feed
from tidewatch.config import RuleConfig
from tidewatch.operators import rapid_fire
from tidewatch.plans import reports
from tidewatch.sources.tables import load_corrections
from tidewatch.streaming import pipeline


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def follow(feed, rules=LIVE):
    pipeline.start_corrections(feed.messages(), rules, feed.stream, available_now=True).awaitTermination()
    return load_corrections(feed.spark, str(feed.out))


def reasons(feed):
    rows = reports.corrected_results(feed.spark, str(feed.out))
    assert rows.columns == feed.results().columns
    return {r.transaction_id: (r.is_fraud, r.fraud_reason) for r in rows.collect()}


def brute_force(rows, rules):
    """(id, window start in seconds, count) of all rows in hot windows, window by window."""
    slide, size, found = rules.rapid_slide_seconds, rules.rapid_window_seconds, set()
    for user in {u for _, u, _ in rows}:
        own = [(t, s) for t, u, s in rows if u == user]
        first = min(s for _, s in own) // slide * slide - size
        for start in range(int(first), int(max(s for _, s in own)) + 1, slide):
            inside = [t for t, s in own if start <= s < start + size]
            if len(inside) > rules.rapid_limit:
                found |= {(t, start, len(inside)) for t in inside}
    return found


@pytest.mark.parametrize("size, slide", [(60, 30), (60, 5), (60, 60)])
def test_rows_with_their_windows(txns, size, slide):
    rules = RuleConfig(rapid_window_seconds=size, rapid_slide_seconds=slide, rapid_limit=3)
    draw = random.Random(size + slide)
    rows = [(f"t{i}", f"u{draw.randrange(4)}", draw.randrange(900)) for i in range(240)]
    df = txns(rows)
    got = {
        (r.transaction_id, (r.window_start - START).total_seconds(), r.txn_count)
        for r in rapid_fire.burst_rows(df, rules).collect()
    }
    assert got == brute_force(rows, rules) and got
    direct, by_pane = rapid_fire.window_counts(df, rules), rapid_fire.window_counts_by_pane(df, rules)
    assert set(map(tuple, direct.collect())) == set(map(tuple, by_pane.collect()))


def test_no_rows_and_rows_without_user_or_time(txns):
    rules = RuleConfig(rapid_limit=1)
    assert rapid_fire.burst_rows(txns([("a", "u", 0)]).limit(0), rules).isEmpty()
    odd = txns([("a", None, 0), ("b", None, 1), ("c", "u", None), ("d", "u", None)])
    assert rapid_fire.burst_rows(odd, rules).isEmpty()


def test_a_burst_across_batches_corrects_what_is_stored(feed):
    feed.send(*[(f"b{i}", "u", 10 + i) for i in range(3)], ("lone", "w", 10))
    feed.send(*[(f"b{i}", "u", 10 + i) for i in range(3, 6)], ("far", "u", 20, FAR))
    feed.send(("later", "v", 3600))
    feed.send(("big", "v", 3601, HOME, 1e5))
    feed.score()
    before = reasons(feed)
    assert before["b0"] == (False, None) and before["far"] == (True, "location_anomaly")
    named = follow(feed)
    assert {(r.transaction_id, r.txn_count) for r in named.collect()} == {
        (t, 7) for t in ("b0", "b1", "b2", "b3", "b4", "b5", "far")
    }
    assert named.count() == 14  # two windows, each once
    assert reasons(feed) == {
        **{f"b{i}": (True, "rapid_fire") for i in range(6)},
        "far": (True, "rapid_fire+location_anomaly"),
        "lone": (False, None),
        "later": (False, None),
        "big": (True, "high_value"),
    }
    assert feed.results().count() == 10  # as they were


def test_open_windows_wait_and_a_restart_goes_on(feed):
    feed.send(*[(f"b{i}", "u", i) for i in range(4)])
    assert follow(feed).isEmpty()
    feed.send(*[(f"b{i}", "u", i) for i in range(4, 6)])
    assert follow(feed).isEmpty()
    feed.send(("later", "v", 3600))
    feed.send(("next", "v", 3601))
    assert {r.transaction_id for r in follow(feed).collect()} == {f"b{i}" for i in range(6)}
    feed.send(("late", "u", 5), ("end", "v", 9000))  # its window has closed
    feed.send(("end2", "v", 9001))
    assert "late" not in {r.transaction_id for r in follow(feed).collect()}


def test_a_shuffled_stream_names_the_rows_of_the_batch(feed, txns):
    rules = RuleConfig(rapid_limit=2)
    draw = random.Random(7)
    rows = [(f"t{i}", f"u{draw.randrange(5)}", i * 4 + draw.randrange(60)) for i in range(300)]
    for at in range(0, 300, 60):
        part = rows[at : at + 60]
        draw.shuffle(part)
        feed.send(*part)
    feed.send(("clock", "clock", 30_000))
    feed.send(("clock2", "clock", 30_001))
    feed.score()
    got = {
        (r.transaction_id, (r.window_start - START).total_seconds(), r.txn_count)
        for r in follow(feed, rules).collect()
    }
    assert got == brute_force(rows, rules) and got
    flagged = rapid_fire.flag_rows(txns(rows), rules).filter("fraud_rapid_fire")
    corrected = reports.corrected_results(feed.spark, str(feed.out)).filter("fraud_rapid_fire")
    assert {r.transaction_id for r in corrected.collect()} == {r.transaction_id for r in flagged.collect()}


def test_any_number_of_corrections_is_one(txns):
    stored = txns([("a", "u", 0), ("b", "u", 0), ("a", "v", 0)])
    for column, kind in [("fraud_high_value", "boolean"), ("fraud_rapid_fire", "boolean"),
                         ("fraud_location_anomaly", "boolean"), ("is_fraud", "boolean"), ("fraud_reason", "string")]:
        stored = stored.withColumn(column, F.lit(None).cast(kind))
    named = stored.filter("transaction_id = 'a' and user_id = 'u'").select(*rapid_fire.CORRECTION_KEYS)
    got = rapid_fire.correct(stored, named.unionAll(named))
    assert {(r.transaction_id, r.user_id): r.fraud_reason for r in got.collect()} == {
        ("a", "u"): "rapid_fire", ("b", "u"): None, ("a", "v"): None,
    }
    assert got.count() == 3 and START + timedelta(0) in {r.event_time for r in got.collect()}
