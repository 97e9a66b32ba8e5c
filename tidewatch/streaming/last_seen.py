"""Keeps each user's last location across micro-batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# Ship this small module with the query, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "event_us bigint, transaction_id string, latitude double, longitude double"
LAST_SEEN = f"user_id string, {STATE}"
FIELDS = ["event_us", "transaction_id", "latitude", "longitude"]
USER = "user_id"
#: The last rows of a group of users, one list for each column of ``LAST_SEEN``.
GROUP_STATE = ", ".join(f"{name}s array<{kind}>" for name, kind in (c.split() for c in LAST_SEEN.split(", ")))


def sightings(rows: DataFrame, *more: Column) -> DataFrame:
    """Who was where and when: all that the state needs. Times are numbers, as a far-off date
    that Spark can hold must not fail in Python."""
    micros = F.unix_micros("event_time").alias("event_us")
    return rows.select("user_id", micros, "transaction_id", "latitude", "longitude", *more)


#: So many rows are held before they are reduced; a task's users are held on while they are half as many.
HELD_ROWS = 200_000


def newest_per_user(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last row in order of each user in the chunks: all that the state needs of them.

    Runs before the rows are shuffled and after, so a user with very many rows in a batch
    reaches its state call as one row, or a few where a task has more users than it holds.
    """
    held, rows = [], 0
    for chunk in chunks:
        held.append(chunk)
        rows += len(chunk)
        if rows >= HELD_ROWS:
            newest = _last_of_each(held)
            held, rows = [newest], len(newest)
            if 2 * rows > HELD_ROWS:
                yield newest
                held, rows = [], 0
    if held:
        yield _last_of_each(held)


def _last_of_each(chunks: list[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(chunks, ignore_index=True) if len(chunks) > 1 else chunks[0]
    newest = rows.groupby("user_id")["event_us"].transform("max")
    latest = rows[rows["event_us"] == newest]
    return latest.sort_values(FIELDS, kind="stable", na_position="first").drop_duplicates("user_id", keep="last")


def _newest(chunk: pd.DataFrame) -> tuple:
    """The last row in order, with missing coordinates as None."""
    latest = chunk
    if len(latest) > 1:  # mostly it is one row, and each step costs as much as for many
        latest = chunk[chunk["event_us"] == chunk["event_us"].max()]
        latest = latest.sort_values(FIELDS, kind="stable", na_position="first")
    event_us, transaction_id, *place = (latest[f].array[-1] for f in FIELDS)
    return int(event_us), transaction_id, *(None if pd.isna(p) else float(p) for p in place)


def tracker(ttl_seconds: int) -> Callable:
    """The state function where users unseen for ``ttl_seconds`` are forgotten."""

    def last_seen(key, chunks, state):
        """Yield where the user was before this micro-batch; remember where they are now.

        Chunks are read one after the other, so a user with many rows in a batch
        needs no more memory than one chunk. State never moves back in time.
        """
        if state.hasTimedOut:
            state.remove()
            return
        before = state.get if state.exists else None
        if before is not None:
            yield pd.DataFrame([(key[0], *before)], columns=["user_id", *FIELDS])
        newest = before
        for chunk in chunks:
            candidate = _newest(chunk)
            if newest is None or candidate[:2] > newest[:2]:
                newest = candidate
        if newest is not before:
            state.update(newest)
        state.setTimeoutDuration(ttl_seconds * 1000)

    return last_seen


class LastSeen(StatefulProcessor):
    """Where each user was before a micro-batch, kept for ever; rows and state go one by one.

    A user costs a few calls to the state. That is a fraction of what a user costs in ``tracker``,
    whose every call carries frames of its own.

    A query may start with the users of an earlier run (``resumed``): their last rows are the
    operator's initial state, read once, before the first micro-batch. Then of rows equal in time and
    id the one with the larger coordinates is the last; else the one that came in an earlier batch.
    """

    def __init__(self, resumed: bool = False):
        self.resumed = resumed

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update(tuple(initialState[f] for f in FIELDS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Yield where the user was before this micro-batch; remember where they are now."""
        before = self.last.get()  # None if there is none
        if before is not None:
            before = tuple(before)
            yield Row(user_id=key[0], **dict(zip(FIELDS, before)))
        newest = max((tuple(row[f] for f in FIELDS) for row in rows), key=in_order, default=None)
        if newest is not None and (before is None or self._later(newest, before)):
            self.last.update(newest)

    def _later(self, newest: tuple, before: tuple) -> bool:
        return in_order(newest) > in_order(before) if self.resumed else newest[:2] > before[:2]


class LastSeenGroup(LastSeen):
    """``LastSeen`` for a group of users, whose last rows are one value in the state, as columns.

    A call to the state costs as much as many rows, and so does a row in it: so a group is read
    once and, if a user in it moved on, written once, however many of its users a micro-batch has.
    """

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", GROUP_STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        users = zip(*(initialState[f"{c}s"] for c in (USER, *FIELDS)))
        self._keep({user: tuple(seen) for user, *seen in users})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Yield where the group's users in this micro-batch were before it; remember where they are now."""
        newest: dict = {}
        for row in rows:
            user, *seen = (row[c] for c in (USER, *FIELDS))
            if user not in newest or in_order(seen) > in_order(newest[user]):
                newest[user] = tuple(seen)
        kept = self.last.get()  # None if there is none
        known = {} if kept is None else {user: tuple(seen) for user, *seen in zip(*kept)}
        moved = False
        for user, seen in newest.items():
            before = known.get(user)
            if before is not None:
                yield Row(user_id=user, **dict(zip(FIELDS, before)))
            if before is None or self._later(seen, before):
                known[user], moved = seen, True
        if moved:
            self._keep(known)

    def _keep(self, known: dict) -> None:
        self.last.update(tuple(map(list, zip(*((user, *seen) for user, seen in known.items())))))


def in_order(seen: Sequence) -> tuple:
    """As ``FIELDS`` are sorted, missing coordinates first."""
    event_us, transaction_id, *place = seen
    return event_us, transaction_id, *((p is not None, p or 0.0) for p in place)
