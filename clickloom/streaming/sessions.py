"""Inactivity sessions on a stream, in arrival order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.functions import is_blank, session_id
from clickloom.operators.sessions import GAP_MINUTES

# Python workers rename columns with a leading underscore.
_MICROS = "event_micros"
_KEY = "session_key"


class SessionNumberer(StatefulProcessor):
    """Keeps the session number and last event time of an account."""

    def __init__(self, gap_minutes: int) -> None:
        self._gap = gap_minutes * 60 * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._reached = handle.getValueState("reached", "session_no int, last_micros bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Go on from the session and the time that a batch job has reached."""
        for number, last in zip(initialState["session_no"], initialState["last_micros"]):
            self._reached.update((int(number), None if pd.isna(last) else int(last)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("seq")
        if not key[0].strip():
            yield batch.assign(session_no=pd.array([None] * len(batch), dtype="Int32"))
            return
        number, last = self._reached.get() or (1, None)
        times = batch[_MICROS].to_numpy(dtype="float64", na_value=np.nan)
        timed = np.flatnonzero(~np.isnan(times))
        flags = np.zeros(len(batch), dtype=bool)
        if len(timed):
            exact = batch[_MICROS].iloc[timed].to_numpy(dtype="int64")
            steps = np.diff(exact, prepend=exact[0] if last is None else last)
            flags[timed] = steps > self._gap
            last = int(exact[-1])
        numbers = number + np.cumsum(flags)
        self._reached.update((int(numbers[-1]), last))
        yield batch.assign(session_no=numbers.astype("int32"))


def sessions_reached(numbered: DataFrame) -> DataFrame:
    """Per account the session and the last time that ``sessionize_arrival`` has reached: rows
    ``acc_id, session_no, last_micros``, the snapshot a stream can start from."""
    timed = F.col("event_ts").isNotNull()
    return numbered.where(~is_blank("acc_id")).groupBy("acc_id").agg(
        F.max("session_no").alias("session_no"),
        F.max(F.when(timed, F.struct("seq", F.unix_micros("event_ts").alias("micros"))))["micros"].alias("last_micros"),
    )


def stream_sessions(
    events: DataFrame, gap_minutes: int = GAP_MINUTES, reached: DataFrame | None = None
) -> DataFrame:
    """Streaming form of ``sessionize_arrival``, for the same rows: without an account there is
    no session, without a time that of the row before.

    Rows of an account within a micro-batch are ordered by ``seq``; the source's per-trigger
    limit bounds how many there can be. Rows without an account are spread by ``seq``. ``reached``, rows of
    ``sessions_reached`` over all earlier events, is taken over by the first run of a checkpoint.
    """
    blank = F.repeat(F.lit(" "), (F.pmod("seq", F.lit(64)) + 1).cast("int"))
    account = F.when(is_blank("acc_id"), blank).otherwise(F.col("acc_id"))
    keyed = events.withColumns({_MICROS: F.unix_micros("event_ts"), _KEY: account})
    keyed = keyed.drop("event_ts", "session_id")
    output = T.StructType([*keyed.schema.fields, T.StructField("session_no", T.IntegerType())])
    initial = None
    if reached is not None:
        initial = reached.select(F.col("acc_id").alias(_KEY), "session_no", "last_micros").groupBy(_KEY)
    numbered = keyed.groupBy(_KEY).transformWithStateInPandas(
        SessionNumberer(gap_minutes), output, outputMode="Append", timeMode="None", initialState=initial
    )
    number = F.col("session_no")
    return (
        numbered.withColumn("event_ts", F.timestamp_micros(_MICROS))
        .withColumn("session_id", F.when(number.isNotNull(), session_id(number)))
        .drop(_MICROS, _KEY)
    )
