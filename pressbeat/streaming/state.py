"""State with a time to live: a count per key that ends, and is handed on, once its key has been silent for so long."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

LIVES = "start bigint, last bigint, n bigint"
RESULT = "n bigint, expires bigint"


def merged(lives: list[tuple[int, int, int]], ttl: int) -> list[tuple[int, int, int]]:
    """(first event, last event, count) in order, those less than ``ttl`` apart as one; times in microseconds."""
    out: list[tuple[int, int, int]] = []
    for start, last, n in sorted(lives):
        if out and start - out[-1][1] <= ttl:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((start, last, n))
    return out


class Lives(StatefulProcessor):
    """The open lives of one key. An event joins the lives it is near enough to, whatever the order of arrival.

    A timer is set at the end of each life. When the clock passes it the life is handed on and dropped, unless a later event has moved
    its end, which has a timer of its own. By event time the clock is the watermark; by processing time it is the executor's, so a
    life ends although the source stays idle.
    """

    def __init__(self, key: str, ttl: int, by_event_time: bool):
        self.key, self.ttl, self.by_event_time = key, ttl, by_event_time

    def init(self, handle) -> None:
        self.handle = handle
        self.lives = handle.getListState("lives", LIVES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        new = []
        for batch in rows:
            if self.by_event_time:
                new += [(t, t, n) for t, n in batch["micros"].value_counts().items()]
            else:
                new.append((now, now, len(batch)))
        self.keep(merged([tuple(x) for x in self.lives.get()] + [tuple(map(int, x)) for x in new], self.ttl))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        known = merged([tuple(x) for x in self.lives.get()], self.ttl)
        over = [x for x in known if x[1] + self.ttl < now]
        if over:
            self.keep([x for x in known if x[1] + self.ttl >= now])
            yield pd.DataFrame({self.key: [key[0]] * len(over), "n": [n for _, _, n in over], "expires": [last + self.ttl for _, last, _ in over]})

    def keep(self, lives: list[tuple[int, int, int]]) -> None:
        if lives:
            self.lives.put(lives)
        else:
            self.lives.clear()
        for _, last, _ in lives:
            self.handle.registerTimer((last + self.ttl) // 1000 + 1)

    def close(self) -> None:
        pass


def expiring_counts(events: DataFrame, key: str, ttl_seconds: int, by_event_time: bool = True) -> DataFrame:
    """(key, n, expires): the count of each life of a key, once it is over: ``ttl_seconds`` after its last event."""
    kind = dict(events.dtypes)[key]
    counted = events.select(key, "event_time", F.unix_micros("event_time").alias("micros")).groupBy(key)
    done = counted.transformWithStateInPandas(Lives(key, ttl_seconds * 1_000_000, by_event_time), f"{key} {kind}, {RESULT}", "append", "EventTime" if by_event_time else "ProcessingTime")
    return done.select(key, "n", F.timestamp_micros("expires").cast("timestamp_ntz").alias("expires"))
