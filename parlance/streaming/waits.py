"""Longest follow-up waits of events on a stream: final once no message of an event has come for a while."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parlance.functions.worktime import CLOSES, DAY, OPENS

OUT = "corp string, room string, event_no bigint, messages bigint, first_msg_time timestamp, last_msg_time timestamp, followup_wait bigint"
_EPOCH = datetime(1970, 1, 1)


def _elapsed(t: datetime) -> int:
    of_day = (t - t.replace(hour=0, minute=0, second=0, microsecond=0)) // timedelta(seconds=1)
    return (t - _EPOCH).days * DAY + min(max(of_day, OPENS), CLOSES) - OPENS


def longest_wait(messages: list[tuple[datetime, str]]) -> int:
    """As functions.extraction's followup_wait, of (time, role) in order."""
    replied, since, most = False, None, 0
    for at, role in messages:
        if role == "INTERNAL":
            if replied and since is not None:
                most = max(most, _elapsed(at) - _elapsed(since))
            replied, since = True, None
        elif role == "EXTERNAL" and replied and since is None:
            since = at
    return most


class Waits(StatefulProcessor):
    """State of an event: its messages' times, ids and roles. A timer ends it when the watermark is `idle` past its last message."""

    def __init__(self, idle: timedelta) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", "at timestamp, msg_id string, role string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, ARG002, N802, N803
        new = [(r.at_.to_pydatetime(), r.msg_id, r.sender_role) for part in rows for r in part.itertuples()]
        self.messages.appendList(new)
        last = max(at for at, _, _ in self.messages.get())
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int((pd.Timestamp(last) + self.idle).timestamp() * 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, ARG002, N802, N803
        rows = sorted(set(self.messages.get()))
        self.messages.clear()
        wait = longest_wait([(pd.Timestamp(at).to_pydatetime(), role) for at, _, role in rows])
        yield pd.DataFrame({"corp": [key[0]], "room": [key[1]], "event_no": [key[2]], "messages": [len(rows)], "first_msg_time": [rows[0][0]], "last_msg_time": [rows[-1][0]], "followup_wait": [wait]})

    def close(self) -> None:
        pass


def followup_waits(messages: DataFrame, lateness: str = "1 hour", idle: timedelta = timedelta(days=3)) -> DataFrame:
    """One row for each event (corp, room, event_no) once it is over. messages: those columns, msg_id, at and sender_role.

    Messages may come out of order by the lateness bound, and twice; later ones are dropped. What an event keeps is small (three
    values a message) and goes when it ends. An event that goes on after `idle` without a word is another event. The session's
    time zone must be UTC, as times are wall-clock times.
    """
    timed = messages.withColumn("at_", F.col("at").cast("timestamp")).withWatermark("at_", lateness)
    rows = timed.select("corp", "room", F.col("event_no").cast("long").alias("event_no"), "msg_id", "at_", "sender_role")
    return rows.groupBy("corp", "room", "event_no").transformWithStateInPandas(Waits(idle), OUT, "Append", "EventTime")
