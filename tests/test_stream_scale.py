"""What a stream's work grows with: tasks that read a step, calls to the state per user."""

import random
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.config import RuleConfig
from tidewatch.plans import catalog
from tidewatch.session import streaming_session
from tidewatch.streaming import last_seen, release
from tidewatch.streaming.last_seen import FIELDS, LastSeen, LastSeenGroup, newest_per_user
from tidewatch.streaming.location import _group_states, locate
from tidewatch.streaming.release import OrderedGroup, OrderedUser, in_time_order


def test_a_step_has_few_files_and_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(400_000).selectExpr("id", "xxhash64(id) as a", "xxhash64(id, 1) as b")
    catalog._write_step(rows, f"{tmp_path}/step")
    assert len(list((tmp_path / "step").glob("*.parquet"))) == catalog.FILES_PER_STEP
    read = streaming_session(spark).read.parquet(f"{tmp_path}/step")
    full = sum(n > 0 for n in read.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
    assert full > catalog.FILES_PER_STEP
    assert read.count() == 400_000


class Value:
    def __init__(self, value=None):
        self.value = value

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Rows(list):
    def get(self):
        return iter(list(self))

    def put(self, rows):
        self[:] = rows

    appendList = list.extend


def ordered_user(pane_seconds=60):
    user, timers = OrderedUser(pane_seconds), set()
    user.handle = SimpleNamespace(registerTimer=timers.add)
    user.waiting, user.last = Rows(), Value()
    return user, timers


def at(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def row(second, name):
    return {"event_us": second * 1_000_000, "transaction_id": name, "latitude": 1.0, "longitude": 2.0, "row": name}


def test_a_timer_is_set_for_the_earliest_pane_alone():
    user, timers = ordered_user()
    assert not list(user.handleInputRows(("u",), [row(250, "c"), row(10, "a"), row(70, "b")], at(0)))
    assert timers == {60_000}
    timers.clear()
    names = [r.row for r in user.handleExpiredTimer(("u",), at(130_000), None)]
    assert names == ["a", "b"] and timers == {300_000}
    # A row of an earlier pane than all that wait sets one of its own.
    assert not list(user.handleInputRows(("u",), [row(185, "d")], at(130_000)))
    assert timers == {240_000, 300_000}
    assert [r.row for r in user.handleExpiredTimer(("u",), at(240_000), None)] == ["d"]
    assert [r.row for r in user.handleExpiredTimer(("u",), at(300_000), None)] == ["c"]
    assert not user.waiting


@pytest.mark.parametrize(("resumed", "latitude"), [(False, 1.0), (True, 5.0)])
def test_copies_of_the_last_row_across_batches(resumed, latitude):
    user = LastSeen(resumed)
    user.last = Value()
    assert not list(user.handleInputRows(("u",), iter([row(5, "a"), row(4, "z")]), None))
    copy = row(5, "a") | {"latitude": 5.0}
    (before,) = user.handleInputRows(("u",), iter([copy]), None)
    assert (before.transaction_id, before.latitude) == ("a", 1.0)
    assert user.last.get()[2] == latitude


def seen(user, second, name, latitude=1.0):
    return {"user_id": user, **{f: row(second, name)[f] for f in FIELDS}, "latitude": latitude}


class Counted(Value):
    reads = writes = 0

    def get(self):
        self.reads += 1
        return super().get()

    def update(self, value):
        self.writes += 1
        super().update(value)


def test_a_group_of_users_is_read_and_written_once():
    group = LastSeenGroup()
    group.last = Counted()
    users = [f"u{i}" for i in range(50)]
    assert not list(group.handleInputRows((0,), iter([seen(u, 5, "a", None) for u in users]), None))
    assert (group.last.reads, group.last.writes) == (1, 1)
    later = [seen(u, second, "b") for u in users for second in (4, 6)] + [seen("new", 1, "c")]
    before = {r.user_id: (r.event_us, r.transaction_id, r.latitude) for r in group.handleInputRows((0,), iter(later), None)}
    assert before == {u: (5_000_000, "a", None) for u in users}
    assert (group.last.reads, group.last.writes) == (2, 2)
    kept = {u: (time, name) for u, time, name, *_ in zip(*group.last.value)}
    assert kept == {u: (6_000_000, "b") for u in users} | {"new": (1_000_000, "c")}
    # A row from before changes nothing, so nothing is written.
    (old,) = group.handleInputRows((0,), iter([seen("u7", 2, "z")]), None)
    assert (old.transaction_id, group.last.writes) == ("b", 2)


@pytest.mark.parametrize(("resumed", "latitude"), [(False, 1.0), (True, 5.0)])
def test_copies_of_the_last_row_in_a_group(resumed, latitude):
    group = LastSeenGroup(resumed)
    group.last = Value()
    list(group.handleInputRows((0,), iter([seen("u", 5, "a"), seen("v", 9, "b")]), None))
    list(group.handleInputRows((0,), iter([seen("u", 5, "a", 5.0)]), None))
    assert {u: place for u, _, _, place, _ in zip(*group.last.value)} == {"u": latitude, "v": 1.0}


def test_users_known_from_before_as_groups(spark):
    rows = [(f"u{i}", i, f"t{i}", None if i == 3 else float(i), 2.0) for i in range(40)]
    known = spark.createDataFrame(rows, "user_id string, s long, transaction_id string, latitude double, longitude double")
    states = _group_states(known.withColumn("event_time", F.timestamp_seconds("s")).drop("s")).collect()
    found = []
    for state in states:
        group = LastSeenGroup(resumed=True)
        group.last = Value()
        group.handleInitialState((state["_group"],), state, None)
        found += zip(*group.last.value)
    assert sorted(found) == sorted((u, s * 1_000_000, *rest) for u, s, *rest in rows)


@pytest.mark.parametrize("held", [7, 40, 1000])
def test_many_chunks_of_the_same_users_become_one_row_each(monkeypatch, held):
    monkeypatch.setattr(last_seen, "HELD_ROWS", held)
    rows = pd.DataFrame([seen(f"u{i % 9}", i * 37 % 101, f"t{i}") for i in range(90)])
    parts = list(newest_per_user(rows.iloc[i : i + 5] for i in range(0, 90, 5)))
    expected = rows.sort_values(FIELDS).drop_duplicates("user_id", keep="last")
    found = pd.concat(parts).sort_values(FIELDS).drop_duplicates("user_id", keep="last")
    assert found[["user_id", *FIELDS]].values.tolist() == expected[["user_id", *FIELDS]].values.tolist()
    if held > 18:  # the users are less than half of what is held
        assert len(parts) == 1 and len(parts[0]) == 9


BATCH = "transaction_id string, user_id string, second long, latitude double, longitude double, reject_reason string, is_seed boolean"


@pytest.mark.parametrize("segment_rows", [None, 2])
def test_late_rows_take_the_pass_of_the_others(spark, segment_rows):
    rows = [("s", "u", 100, 9.0, 9.0, None, True), ("x", "w", 7, 1.0, 1.0, "missing_user_id", False)]
    rows += [(f"t{i}", "u", second, float(i), 0.0, None, False) for i, second in enumerate((10, 20, 100, 110, 120))]
    rows += [(f"v{i}", "v", i, float(i), 0.0, None, False) for i in range(3)]
    batch = spark.createDataFrame(rows, BATCH).withColumn("event_time", F.timestamp_seconds("second")).drop("second")
    located = locate(batch, RuleConfig(segment_rows=segment_rows))
    found = {r.transaction_id: (r.prev_lat, r.out_of_order) for r in located.collect()}
    assert found == {
        "t0": (None, True),
        "t1": (None, True),
        "t2": (9.0, False),  # equal in time to the seed, and of a larger id
        "t3": (2.0, False),
        "t4": (3.0, False),
        "v0": (None, False),
        "v1": (0.0, False),
        "v2": (1.0, False),
        "x": (None, False),
    }
    if segment_rows is None:
        assert located._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def ordered_group(pane_seconds=60):
    group, timers = OrderedGroup(pane_seconds), set()
    group.handle = SimpleNamespace(registerTimer=timers.add)
    group.waiting, group.due, group.last = Tables(), Due(), Counted()
    return group, timers


class Due(Value):
    def clear(self):
        self.value = None


class Tables(Rows):
    reads = writes = 0

    def get(self):
        self.reads += 1
        return super().get()

    def put(self, rows):
        self.writes += 1
        super().put(rows)

    def appendList(self, rows):
        self.writes += 1
        self.extend(rows)


WAITING = pa.schema([("user_id", "string"), ("event_time", "int64"), ("transaction_id", "string")])
WAITING = WAITING.append(pa.field("latitude", "float64")).append(pa.field("longitude", "float64"))


def waiting_table(rows):
    named = [{**r, "event_time": r["event_us"]} for r in rows]
    return {"rows": release._packed(pa.Table.from_pylist(named, WAITING))}


def left(packed):
    """Rows as they leave a group, as ``OrderedUser`` has them."""
    for table in packed:
        for r in release._unpacked(table.rows).to_pylist():
            yield (r["transaction_id"], *(r[c] for c in ("prev_lat", "prev_lon", "out_of_order", "watermark_ms")))


def fire(processor, timers, watermark):
    """As Spark does: each timer that the watermark has passed, earliest first."""
    out = []
    for timer in sorted(t for t in timers if t <= watermark):
        out += processor.handleExpiredTimer((0,), at(watermark), None)
        timers.discard(timer)
    return out


@pytest.mark.parametrize("packed_rows", [1, 7, 2000])
def test_a_group_of_users_releases_what_each_of_them_would(monkeypatch, packed_rows):
    monkeypatch.setattr(release, "PACKED_ROWS", packed_rows)
    draw = random.Random(3)
    users = [f"u{i}" for i in range(12)]
    known = {u: seen(u, draw.randint(0, 400), "k", draw.choice([None, 3.0])) for u in users[:5]}
    group, timers = ordered_group()
    group.handleInitialState((0,), {f"{c}s": [k[c] for k in known.values()] for c in ("user_id", *FIELDS)}, None)
    alone = {u: ordered_user() for u in users}
    for u, row_ in known.items():
        alone[u][0].handleInitialState((u,), row_, None)
    found, expected, count = [], [], 0
    for watermark in (0, 0, 200_000, 500_000, 500_000, 900_000, 10_000_000):
        rows = []
        for _ in range(60 if watermark < 10_000_000 else 0):
            second, count = max(0, watermark // 1000 + draw.randint(-150, 500)), count + 1
            # Some are equal in time, some in id too, some have no place.
            name = f"t{count}" if draw.random() < 0.7 else "t"
            place = draw.choice([None, 0.0, float(count)])
            rows.append(seen(draw.choice(users), second // 20 * 20, name, place) | {"longitude": draw.choice([None, 2.0])})
        tables = [waiting_table(rows[i : i + 25]) for i in range(0, len(rows), 25)]
        found += left(group.handleInputRows((0,), iter(tables), at(watermark))) if rows else []
        found += left(fire(group, timers, watermark))
        for u, (user, own) in alone.items():
            named = [r | {"row": r["transaction_id"]} for r in rows if r["user_id"] == u]
            expected += map(tuple, user.handleInputRows((u,), iter(named), at(watermark))) if named else []
            expected += map(tuple, fire(user, own, watermark))
    assert len(found) == count == 360 and any(r[3] and r[4] is None for r in found)
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert not group.waiting and group.due.value is None


def test_the_rows_of_a_group_cost_few_calls_to_the_state():
    group, timers = ordered_group()
    rows = [seen(f"u{i % 300}", i, f"t{i}") for i in range(1500)]
    tables = [waiting_table(rows[i : i + 100]) for i in range(0, 1500, 100)]
    assert not list(group.handleInputRows((0,), iter(tables), at(0)))
    assert (group.waiting.writes, timers) == (1, {60_000})
    released = fire(group, timers, 1_200_000)
    assert len(list(left(released))) == 1200 and timers == {1_260_000}
    assert (len(released), group.waiting.reads, group.waiting.writes) == (1, 1, 2)
    assert (group.last.reads, group.last.writes) == (1, 1)
    # A timer whose rows have been released reads nothing.
    assert not list(group.handleExpiredTimer((0,), at(1_200_000), None)) and group.waiting.reads == 1


@pytest.mark.parametrize("held_bytes", [1, 32 << 20])
def test_rows_are_packed_by_group_whole(monkeypatch, held_bytes):
    monkeypatch.setattr(release, "HELD_BYTES", held_bytes)
    monkeypatch.setattr(release, "PACKED_ROWS", 30)
    rows = pa.table({"a": range(1000), "b": [None if i % 3 else f"é{i}" for i in range(1000)], "_group": pa.array([i * 7 % 13 for i in range(1000)], "int32")})
    packed = pa.Table.from_batches(release._pack(iter(rows.to_batches(max_chunksize=64)))).to_pylist()
    tables = [(p["_group"], release._unpacked(p["rows"])) for p in packed]
    assert max(len(t) for _, t in tables) <= 30
    back = [(r["a"], r["b"], group) for group, t in tables for r in t.to_pylist()]
    assert sorted(back, key=lambda r: r[0]) == [tuple(r.values()) for r in rows.to_pylist()]


def test_rows_that_wait_do_not_travel_as_text(spark):
    rows = spark.readStream.format("rate").load().selectExpr(
        "cast(value as string) as user_id", "timestamp as event_time", "cast(value as string) as transaction_id", "1d as latitude", "2d as longitude"
    )
    ordered = in_time_order(rows, "1 minute", 60)
    assert ordered.columns == [*rows.columns, "prev_lat", "prev_lon", "out_of_order", "late_by"]
    assert ordered.schema["event_time"].dataType == rows.schema["event_time"].dataType
    assert "json" not in ordered._jdf.queryExecution().analyzed().toString()
