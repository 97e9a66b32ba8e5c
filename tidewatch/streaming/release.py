"""Rows of a stream in time order: each waits until the watermark has passed it.

Event time is cut into panes. A user's rows wait in state and are released when the
watermark passes the end of their pane, in order, each with the user's location before. So
what a row is compared with does not depend on when rows arrived, as long as they arrived within
the watermark. State holds a user's rows of the watermark's length, and their last row.

A row whose pane has been released already is late. It is not lost: it leaves at once, marked
``out_of_order``, with ``late_by``, the seconds by which the watermark was ahead of it.

Users are kept in groups. A group's rows travel through Python, wait in state and leave as tables
of columns, so neither the state nor Python is called row by row. The rows of one user within a pane
are put in order by one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.streaming.last_seen import FIELDS, STATE, USER, in_order
from tidewatch.streaming.location import _group_states, _in_groups

# Ship this small module with the query, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Users are kept in so many groups; fixed for the life of a checkpoint.
ORDERED_GROUPS = 1024
#: A table on its way has at most so many rows.
PACKED_ROWS = 2000
#: A task holds rows of so many bytes before it packs them.
HELD_BYTES = 32 << 20
PACKED = "_group int, rows binary"
ADDED = "prev_lat double, prev_lon double, out_of_order boolean, watermark_ms long"
#: The last rows of a group of users, as ``LAST_SEEN``.
LAST_ROWS = pa.schema(
    {USER: pa.string(), "event_us": pa.int64(), "transaction_id": pa.string(), "latitude": pa.float64(), "longitude": pa.float64()}
)


class OrderedUser(StatefulProcessor):
    """Holds a user's rows until the watermark reaches the end of their pane.

    A timer is set for the earliest pane that waits, not for each: when it goes off, all panes
    that the watermark has passed are released, and one is set for the earliest of the rest.
    """

    def __init__(self, pane_seconds: int):
        self.pane_ms = pane_seconds * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"{STATE}, row string")
        self.last = handle.getValueState("last", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The user's last row in the tables that the stream goes on from."""
        self.last.update(tuple(initialState[f] for f in FIELDS))

    def _pane_end(self, event_us: int) -> int:
        return (event_us // 1000 // self.pane_ms + 1) * self.pane_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Keep the rows, or pass them on as late where their pane has been released."""
        watermark = timerValues.getCurrentWatermarkInMs()
        kept, first = [], None
        for row in rows:
            end = self._pane_end(row["event_us"])
            if end <= watermark:
                yield _released(row["row"], None, True, watermark)
            else:
                kept.append((*(row[f] for f in FIELDS), row["row"]))
                first = end if first is None else min(first, end)
        if kept:
            self.waiting.appendList(kept)
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Release the rows of all panes that the watermark has passed."""
        watermark = timerValues.getCurrentWatermarkInMs()
        ready, rest = [], []
        for row in map(tuple, self.waiting.get()):
            (ready if self._pane_end(row[0]) <= watermark else rest).append(row)
        if not ready:
            return
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(self._pane_end(row[0]) for row in rest))
        else:
            self.waiting.clear()
        last = self.last.get()  # None if there is none
        last = None if last is None else tuple(last)
        for *seen, row in sorted(ready, key=lambda r: in_order(r[:-1])):
            behind = last is not None and in_order(seen) < in_order(last)
            yield _released(row, None if behind else last, behind, None)
            last = last if behind else tuple(seen)
        self.last.update(last)


def _released(row: str, before: tuple | None, out_of_order: bool, watermark_ms: int | None) -> Row:
    latitude, longitude = before[2:] if before else (None, None)
    return Row(
        row=row, prev_lat=latitude, prev_lon=longitude, out_of_order=out_of_order, watermark_ms=watermark_ms
    )


class OrderedGroup(OrderedUser):
    """``OrderedUser`` for a group of users: rows come, wait and leave as packed tables.

    A call to the state costs as much as many rows, and so does a row that goes through Python alone.
    So the state is called a few times per group, however many rows and users it has, and rows are
    told apart, put in order and given the places before them as columns.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.due = handle.getValueState("due", "pane_end_ms bigint")  # the earliest that waits
        self.last = handle.getValueState("last", "rows binary")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The last rows of the group's users in the tables that the stream goes on from."""
        known = {name: initialState[f"{name}s"] for name in LAST_ROWS.names}
        self.last.update((_packed(pa.table(known, schema=LAST_ROWS)),))

    def _wake(self, pane_end: int) -> None:
        """Have the group called when the watermark passes the pane, unless it is called earlier."""
        due = self.due.get()
        if due is None or pane_end < due[0]:
            self.due.update((pane_end,))
            self.handle.registerTimer(pane_end)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Keep the rows, or pass them on as late where their pane has been released."""
        watermark = timerValues.getCurrentWatermarkInMs()
        kept, first = [], None
        for row in rows:
            late, rest, first = self._parted(row["rows"], watermark, first)
            if late is not None:
                yield from _leaving(late, None, np.ones(len(late), bool), watermark)
            kept += rest
        if kept:
            self.waiting.appendList(kept)  # in one call: each call's cost grows with the list
            self._wake(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Release the rows of all panes that the watermark has passed."""
        watermark = timerValues.getCurrentWatermarkInMs()
        due = self.due.get()
        if due is None or due[0] > watermark:  # an earlier timer has released this one's rows
            return
        ready, rest, first = [], [], None
        for (packed,) in self.waiting.get():
            passed, left, first = self._parted(packed, watermark, first)
            ready += [] if passed is None else [passed]
            rest += left
        self.due.clear()
        if rest:
            self.waiting.put(rest)
            self._wake(first)
        else:
            self.waiting.clear()
        yield from self._with_places(pa.concat_tables(ready))

    def _parted(
        self, packed: bytes, watermark: int, first: int | None
    ) -> tuple[pa.Table | None, list[tuple], int | None]:
        """The rows whose pane the watermark has passed, and the others as the state has them; the
        earliest pane end among the others and ``first``."""
        rows = _unpacked(packed)
        ends = self._pane_end(rows["event_time"].to_numpy())
        passed = ends <= watermark
        if passed.all():
            return rows, [], first
        left = int(ends[~passed].min())
        first = left if first is None else min(first, left)
        if not passed.any():
            return None, [(packed,)], first
        return rows.filter(passed), [(_packed(rows.filter(~passed)),)], first

    def _with_places(self, rows: pa.Table) -> Iterator[Row]:
        """The rows with their users' places before them; each user's last row is remembered."""
        kept = self.last.get()  # None if there is none
        last = LAST_ROWS.empty_table() if kept is None else _unpacked(kept[0])
        seen = rows.select([USER, "event_time", *FIELDS[1:]]).rename_columns(LAST_ROWS.names).cast(LAST_ROWS)
        both = pa.concat_tables([last, seen]).combine_chunks()
        user, order = _user_order(both)
        # Of a user's rows in order, those before the last row that was remembered are behind.
        at = np.arange(len(order))
        remembered = order < len(last)
        since = np.full(user.max() + 1, -1)
        since[user[order[remembered]]] = at[remembered]
        behind = at < since[user[order]]
        starts = np.append(True, np.diff(user[order]) != 0)
        before = np.where(starts | behind, -1, np.roll(order, 1))
        place, out_of_order = np.empty_like(before), np.empty_like(behind)
        place[order], out_of_order[order] = before, behind
        self.last.update((_packed(both.take(order[np.append(starts[1:], True)])),))
        place, out_of_order = place[len(last) :], out_of_order[len(last) :]
        places = both.select(FIELDS[2:]).take(pa.array(place, mask=place < 0))
        yield from _leaving(rows, places, out_of_order, None)


def _user_order(seen: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A number for the user of each row, and the rows' positions by user and then as ``in_order``."""
    user = pc.dictionary_encode(seen[USER], null_encoding="encode").combine_chunks().indices
    keys = {"user": user, **{f: seen[f] for f in FIELDS[:2]}}
    for place in FIELDS[2:]:  # missing ones first
        keys |= {f"{place} is there": pc.cast(pc.is_valid(seen[place]), "int8"), place: seen[place]}
    order = pc.sort_indices(pa.table(keys), sort_keys=[(name, "ascending") for name in keys])
    return user.to_numpy(), order.to_numpy().astype("int64")


def _leaving(
    rows: pa.Table, places: pa.Table | None, out_of_order: np.ndarray, watermark_ms: int | None
) -> Iterator[Row]:
    """The rows as packed tables with the columns ``ADDED``."""
    for place, name in zip(FIELDS[2:], ("prev_lat", "prev_lon")):
        rows = rows.append_column(name, pa.nulls(len(rows), pa.float64()) if places is None else places[place])
    rows = rows.append_column("out_of_order", pa.array(out_of_order))
    rows = rows.append_column("watermark_ms", pa.repeat(pa.scalar(watermark_ms, pa.int64()), len(rows)))
    for table in _pieces(rows):
        yield Row(rows=_packed(table))


def _pieces(rows: pa.Table) -> Iterator[pa.Table]:
    return (rows.slice(at, PACKED_ROWS) for at in range(0, len(rows), PACKED_ROWS))


def _packed(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
        stream.write(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to packed tables, each of one group. A task holds so many rows that a group has many of them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield from _by_group(held)
            held, size = [], 0
    if held:
        yield from _by_group(held)


def _by_group(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches)
    group = rows["_group"].to_numpy()
    order = np.argsort(group, kind="stable")
    group, rows = group[order], rows.drop_columns("_group").take(order)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for start, end in zip(cuts, cuts[1:]):
        packed = [_packed(table) for table in _pieces(rows.slice(start, end - start))]
        groups = pa.array([group[start]] * len(packed), pa.int32())
        yield pa.record_batch({"_group": groups, "rows": pa.array(packed, pa.binary())})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("rows"):
            yield from _unpacked(packed.as_buffer()).to_batches()


def in_time_order(
    rows: DataFrame, watermark: str, pane_seconds: int, known: DataFrame | None = None
) -> DataFrame:
    """The rows of a stream, each once, behind the watermark and with their user's place before.

    Adds ``prev_lat, prev_lon, out_of_order, late_by``; ``late_by`` is NULL for a row on time.
    ``rows`` have a user and an ``event_time``, and no watermark yet; ``known`` has the last row
    of users seen before (see ``sources.tables.last_rows``).
    """
    schema = rows.schema
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
    plain = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in schema.fields]
    )
    whole = [(F.unix_micros(c) if c in times else F.col(c)).alias(c) for c in rows.columns]
    # Micros have no watermark of their own, so Spark drops none of these rows as late.
    waiting = _in_groups(rows.withWatermark("event_time", watermark).select(*whole), ORDERED_GROUPS)
    packed = waiting.repartition("_group").mapInArrow(_pack, PACKED)
    released = packed.groupBy("_group").transformWithState(
        OrderedGroup(pane_seconds),
        "rows binary",
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if known is None else _group_states(known, ORDERED_GROUPS).groupBy("_group"),
    )
    unpacked = released.mapInArrow(_unpack, T.StructType([*plain, *T.StructType.fromDDL(ADDED)]))
    back = [F.timestamp_micros(c).alias(c) if c in times else F.col(c) for c in rows.columns]
    late_by = F.col("watermark_ms") / 1000 - F.col("event_time") / 1_000_000
    return unpacked.select(*back, "prev_lat", "prev_lon", "out_of_order", late_by.alias("late_by"))
