"""Minutes that are put out once, when no more events are waited for."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FINAL, LATE = "final", "late"
# Parts that a minute is counted in, so that a busy one is not one task's.
PARTS = 64
_MINUTE_MS = 60_000


class MinuteCounter(StatefulProcessor):
    """Counts a part of a minute until the watermark has passed it; rows that come later are passed on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._counted = handle.getValueState("counted", "events bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[0]) + _MINUTE_MS
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield pd.DataFrame({"kind": LATE, "minute_ms": int(key[0]), "events": 1, "seq": part["seq"]})
            return
        (before,) = self._counted.get() or (0,)
        self._counted.update((before + sum(len(part) for part in rows),))
        self._handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (events,) = self._counted.get() or (0,)
        self._counted.clear()
        yield pd.DataFrame({"kind": [FINAL], "minute_ms": [int(key[0])], "events": [events], "seq": pd.array([None], "Int64")})


def final_minutes(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream of rows ``kind, minute, events, seq``: for every minute that ended ``delay`` before the
    newest event the ``final`` counts of its parts, once; and for every event that comes later
    than that a ``late`` row with its ``seq``. Both together are ``ingestion_velocity``: nothing
    is dropped. Events without a time are in no minute.

    This is for minutes only; intents and sessions have no watermark.
    """
    timed = events.where(F.col("event_ts").isNotNull()).withWatermark("event_ts", delay)
    minute = F.floor(F.unix_millis("event_ts") / F.lit(_MINUTE_MS)) * _MINUTE_MS
    # Without its time a row is not dropped as late before it gets here.
    keyed = timed.select(
        minute.cast("bigint").alias("minute_ms"),
        F.pmod(F.xxhash64("seq"), F.lit(PARTS)).cast("int").alias("part"),
        F.col("seq").cast("bigint").alias("seq"),
    )
    counted = keyed.groupBy("minute_ms", "part").transformWithStateInPandas(
        MinuteCounter(), "kind string, minute_ms bigint, events bigint, seq bigint",
        outputMode="Append", timeMode="EventTime",
    )
    return counted.select("kind", F.timestamp_millis("minute_ms").alias("minute"), "events", "seq")
