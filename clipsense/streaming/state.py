"""Keyed state: the last videos of each user, with an idle timer.

Spark keeps the state: a list of events, to which new ones are appended, and one
row about it. The list is written anew only once it has grown to twice what is
kept, so a batch writes what it brings, not what is there. A timer ends the state;
if the user has later events when it goes off, it is set anew for the last of them.
Users are many and a user's rows few, so they are handled as plain tuples. Before the rows of a batch meet their
user's state, each task keeps only the latest of every user, so that a hot user
sends at most ``KEEP`` rows a batch of rows, not a history.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clipsense import fixed_values as V
from clipsense.functions.rules import micros

KEEP = 100
#: The state store that keeps lists and timers.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EVENTS = "event_us bigint, video_id string, weight double"
_ABOUT = "newest_us bigint, version bigint, held int, timer_ms bigint"
_OUTPUT = "user_id string, event_us bigint, video_id string, weight double, pos int, n int, version bigint"
_Listed = Row("user_id", "event_us", "video_id", "weight", "pos", "n", "version")


def _newest_first(event: tuple) -> tuple:
    """Order by time, the newest first, then by video; nulls come last."""
    return event[0] is None, -(event[0] or 0), event[1] is None, event[1] or ""


def _latest(events: list[tuple]) -> list[tuple]:
    """Last KEEP events by time, newest first."""
    return sorted(events, key=_newest_first)[:KEEP]


def _after_last_pause(events: list[tuple], ttl_us: int) -> list[tuple]:
    """Newest events up to the first pause longer than the timer."""
    for place, (later, earlier) in enumerate(pairwise(events), 1):
        if earlier[0] is not None and later[0] - earlier[0] > ttl_us:
            return events[:place]
    return events


def latest_of_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last KEEP rows of every user within each batch of rows; no other can be among the last of all."""
    for rows in batches:
        ordered = rows.sort_values(["event_us", "video_id"], ascending=[False, True], kind="stable")
        yield ordered.groupby("user_id", sort=False, dropna=False).head(KEEP)


class RecentVideos(StatefulProcessor):
    """A user's last events; emits the live list, with a rising version, whenever it changes."""

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", _EVENTS)
        self.about = handle.getValueState("about", _ABOUT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = _latest([(r.event_us, r.video_id, r.weight) for r in rows])
        _, version, held, timer = self.about.get() or (None, 0, 0, None)
        live = _latest([tuple(e) for e in self.events.get()] + new) if held else new
        if held + len(new) > 2 * KEEP:
            self.events.put(live)
            held = len(live)
        else:
            self.events.appendList(new)
            held += len(new)
        last = live[0][0]
        # Rises in a user's life, and from one life to the next, whose events are later by more than the timer.
        version = max(version + 1, last)
        if timer is None:
            timer = self._expires(last)
            self.handle.registerTimer(timer)
        self.about.update((last, version, held, timer))
        shown = _after_last_pause(live, self.ttl_us)
        for pos, event in enumerate(shown, 1):
            yield _Listed(key[0], *event, pos, len(shown), version)

    def _expires(self, last: int) -> int:
        return (last + self.ttl_us) // 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest, version, held, _ = self.about.get()
        expires = self._expires(newest)
        if expires > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(expires)
            self.about.update((newest, version, held, expires))
        else:
            self.events.clear()
            self.about.clear()
        return iter([])

    def close(self) -> None:
        pass


def recent_videos_state(events: DataFrame, ttl: int = V.RECENT_TTL, watermark: str = "1 hour") -> DataFrame:
    """Emit a user's live list, with a rising version, whenever it changes; for append mode.

    The state is the last events by time. Which of them are live depends on
    these alone, so the order in which rows and batches arrive does not matter.
    Lists and timers need the state store ``STORE``, which the session is set to.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = events.select(
        "user_id", micros(F.col("event_time")).alias("event_us"), "video_id", "weight", "event_time"
    )
    kept = rows.mapInPandas(latest_of_each, rows.schema).withWatermark("event_time", watermark)
    return kept.groupBy("user_id").transformWithState(RecentVideos(ttl * 1_000_000), _OUTPUT, "append", "EventTime")


def latest_lists(emitted: DataFrame) -> DataFrame:
    """The last list of each user among all that a stream has written."""
    last = emitted.groupBy("user_id").agg(F.max("version").alias("version"))
    return emitted.join(last, ["user_id", "version"])
