"""The audit of a checkpoint's offsets against logs made up here, and those of a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from support import HOME
from test_streaming import Feed
from tidewatch.operators.offset_audit import audit_offsets, troubles
from tidewatch.sources.progress import offset_log


def write_log(path, batches, commits=None):
    """``batches`` gives a batch's number its sources' lines."""
    for name in ("offsets", "commits"):
        (path / name).mkdir(parents=True)
    for number, lines in batches.items():
        head = json.dumps({"batchWatermarkMs": 1000 * number, "batchTimestampMs": 60_000 * number, "conf": {}})
        (path / "offsets" / str(number)).write_text("\n".join(["v1", head, *lines]))
        (path / "offsets" / f".{number}.crc").write_text("x")
    for number in batches if commits is None else commits:
        (path / "commits" / str(number)).write_text('v1\n{"nextBatchWatermarkMs":0}')
    return str(path)


def topic(**partitions):
    return json.dumps({"transactions": {k[1:]: v for k, v in partitions.items()}})


def audit(spark, path):
    rows = audit_offsets(offset_log(spark, path)).collect()
    return {(r.batch_id, r.source, r.topic, r.partition): r for r in rows}


def test_backward_jumps_are_resets(spark, tmp_path):
    """A made-up log of 101 batches, in which a topic was made anew six times."""
    draw, offset, batches, jumps = random.Random(9), 0, {}, {}
    for number in range(21, 122):
        if number in (45, 61, 96, 103, 109, 117):
            jumps[number] = offset
            offset = draw.randrange(offset)
        else:
            offset += draw.randrange(150, 233)
        batches[number] = [topic(p0=offset)]
    path = write_log(tmp_path / "c", batches, commits=range(21, 121))
    found = audit(spark, path)
    assert len(found) == 101
    resets = {r.batch_id: r for r in found.values() if r.verdict == "reset"}
    assert {k: r.previous_offset for k, r in resets.items()} == jumps
    assert all(r.moved < 0 for r in resets.values())
    assert [r.batch_id for r in found.values() if r.replays] == [121]
    assert found[21, 0, "transactions", 0].verdict == "start"
    assert sum(r.verdict == "progress" for r in found.values()) == 101 - 6 - 1
    rows = {r.batch_id for r in troubles(audit_offsets(offset_log(spark, path))).collect()}
    assert rows == {*jumps, 121}


def test_each_place_has_its_own_history(spark, tmp_path):
    batches = {
        0: [topic(p0=5, p1=7), "-"],
        1: [topic(p0=5, p1=9), '{"logOffset":0}'],
        4: [topic(p0=6, p1=9, p2=1), '{"logOffset":3}'],
        5: [topic(p0=6, p1=2, p2=1), "no offset"],
        6: [topic(p0=1, p1=3, p2=1), '{"logOffset":2}'],
    }
    path = write_log(tmp_path / "c", batches, commits=(0, 1, 4))
    found = audit(spark, path)
    t = "transactions"
    verdicts = {key: r.verdict for key, r in found.items()}
    assert verdicts == {
        (0, 0, t, 0): "start", (0, 0, t, 1): "start",
        (1, 0, t, 0): "idle", (1, 0, t, 1): "progress", (1, 1, None, None): "start",
        (4, 0, t, 0): "progress", (4, 0, t, 1): "idle", (4, 0, t, 2): "new_place", (4, 1, None, None): "progress",
        (5, 0, t, 0): "idle", (5, 0, t, 1): "reset", (5, 0, t, 2): "idle", (5, 1, None, None): "unreadable",
        (6, 0, t, 0): "gone_back", (6, 0, t, 1): "progress", (6, 0, t, 2): "idle", (6, 1, None, None): "reset",
    }
    assert {k[0] for k, r in found.items() if r.missing_batches == 2} == {4}
    assert {k[0] for k, r in found.items() if r.replays} == {5, 6}
    last = found[6, 1, None, None]
    assert (last.previous_batch, last.previous_offset, last.moved) == (4, 3, -1)
    assert last.watermark.timestamp() == 6 and last.trigger_time.timestamp() == 360


@pytest.mark.parametrize("line, places", [("7", [(None, None, 7)]), ("{}", []), ('{"a":{},"b":{"3":4}}', [("b", 3, 4)]),
                                          ('{"a":{"0":1},"b":{"0":2}}', [("a", 0, 1), ("b", 0, 2)]), ("", [(None, None, None)])])
def test_forms_of_offsets(spark, tmp_path, line, places):
    rows = offset_log(spark, write_log(tmp_path / "c", {0: [line, "1"]})).filter("source = 0").collect()
    assert sorted((r.topic, r.partition, r.offset) for r in rows) == places


def test_no_checkpoint_and_no_commits(spark, tmp_path):
    assert audit_offsets(offset_log(spark, str(tmp_path / "none"))).isEmpty()
    path = tmp_path / "c"
    write_log(path, {0: ["1"], 1: ["2"]}, commits=())
    (path / "commits").rmdir()
    assert {(r.verdict, r.replays) for r in audit(spark, str(path)).values()} == {("start", True), ("progress", True)}


def test_a_stream_and_its_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send(("a", "u", 0, HOME))
    feed.send(("b", "u", 60, HOME))
    feed.score()
    feed.send(("c", "u", 120, HOME))
    feed.score()
    log = offset_log(spark, f"{feed.out}/_checkpoints/main")
    found = audit_offsets(log).filter(F.col("source") == 0).orderBy("batch_id").collect()
    assert [r.verdict for r in found if r.verdict != "idle"] == ["start", "progress", "progress"]
    assert not any(r.replays for r in found) and troubles(audit_offsets(log)).isEmpty()
