"""Records of whole batches: what a reader of them sees while batches are written and replayed."""

from dataclasses import replace

import pytest

from support import FAR, HOME, SMALL
from test_streaming import LIVE, Feed
from tidewatch.config import RuleConfig
from tidewatch.plans.backfill import backfill
from tidewatch.schema import RESULT_SCHEMA
from tidewatch.sinks import tables
from tidewatch.sources import events
from tidewatch.sources.tables import load_batches, load_recorded, load_results


@pytest.fixture
def feed(spark, tmp_path):
    found = Feed(spark, tmp_path)
    found.stream = replace(found.stream, batch_records=True)
    return found


def seen(feed):
    return [{r.transaction_id for r in df.collect()} for df in load_recorded(feed.spark, str(feed.out))]


def fill(feed):
    feed.send(("a", "u", 0, HOME), ("x", "v", 0, HOME, 1e5))
    feed.send(("b", "u", 60, FAR), ("c", "v", 60, HOME), "no message")
    feed.score()


def test_each_batch_is_recorded_with_its_counts(feed):
    fill(feed)
    rows = load_batches(feed.spark, str(feed.out)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.total, r.alerts, r.rejects, r.alert_rate) for r in rows] == [
        (0, 2, 1, 0, 50.0),
        (1, 2, 1, 1, 50.0),
    ]
    assert [(m.total, m.alerts, m.rejects) for m in feed.metrics] == [(2, 1, 0), (2, 1, 1)]
    assert seen(feed) == [{"a", "c"}, {"x", "b"}]


@pytest.mark.parametrize("step", ["write_clean", "write_alerts", "write_alerts_csv", "write_rejects", "record_batch"])
def test_a_batch_is_seen_whole_or_not_at_all(feed, monkeypatch, step):
    """The second batch fails at each step in turn, then is replayed; so is one that was whole."""
    given, calls = getattr(tables, step), []

    def failing(*args, **kwargs):
        calls.append(step)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return given(*args, **kwargs)

    monkeypatch.setattr(tables, step, failing)
    with pytest.raises(Exception, match="lost"):
        fill(feed)
    assert seen(feed) == [{"a"}, {"x"}]
    feed.score()
    assert seen(feed) == [{"a", "c"}, {"x", "b"}]
    again = feed.spark.createDataFrame([], RESULT_SCHEMA)
    tables.open_batch(feed.spark, str(feed.out), 1)  # as a replay begins
    tables.write_clean(again, str(feed.out), 1)
    assert seen(feed) == [{"a"}, {"x"}]


def test_other_batches_are_left_out(feed):
    fill(feed)
    tables.open_batch(feed.spark, str(feed.out), 0)
    clean, alerts = load_recorded(feed.spark, str(feed.out))
    assert clean.columns == alerts.columns == RESULT_SCHEMA.fieldNames()
    assert {r.batch_id for r in clean.unionByName(alerts).collect()} == {1}


def test_nothing_recorded(feed):
    assert seen(feed) == [set(), set()]
    feed.stream = replace(feed.stream, batch_records=False)
    fill(feed)
    assert seen(feed) == [set(), set()] and feed.results().count() == 4


def test_a_bulk_load_is_recorded(spark, tmp_path):
    raw = events.to_messages(events.transactions(spark, SMALL))
    for _ in range(2):
        backfill(raw, RuleConfig(amount_limit=150.0), str(tmp_path), 7, batch_records=True)
    (record,) = load_batches(spark, str(tmp_path)).collect()
    clean, alerts = load_recorded(spark, str(tmp_path))
    assert (record.batch_id, record.total, record.alerts) == (7, raw.count(), alerts.count())
    assert clean.count() + alerts.count() == record.total and record.rejects == 0
    assert load_results(spark, str(tmp_path))[0].count() == clean.count()
