"""Inactivity sessions per account, numbered from 1.

A new session starts when the gap to the account's previous event is strictly longer than
the timeout. A step back in time is no gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from clickloom.functions import epoch_cell, floor_div, is_blank, session_id
from clickloom.plans import HOT_ROWS, SPAN, hot_keys

GAP_MINUTES = 15

# Fixed width of the time cells; must not exceed the timeout.
CELL_SECONDS = 60

_NO_TIME = -(1 << 60)

# Helper columns, under names that input columns do not have.
_CELL, _RANGE, _BASE, _FLAG = "__cell", "__range", "__base", "__flag"


def _gap_flag(ts, previous, gap_minutes: int):
    longer = F.unix_micros(ts) - F.unix_micros(previous) > gap_minutes * 60 * 1_000_000
    return F.coalesce(longer, F.lit(False)).cast("long")


def session_cells(
    events: DataFrame, gap_minutes: int = GAP_MINUTES, cell_seconds: int = CELL_SECONDS
) -> DataFrame:
    """``acc_id, cell, session_no``: the session of every occupied time cell.

    Events of one account in one cell are closer together than the timeout, so they share a
    session and only the cell's first and last time matter. The pre-aggregation
    combines on the map side; the window then sees one row per occupied cell, at most
    one per minute of history however many events an account has.
    """
    if cell_seconds > gap_minutes * 60:
        raise ValueError("cells must not be wider than the session timeout")
    cells = (
        events.where(~is_blank("acc_id"))
        .groupBy("acc_id", _cell(cell_seconds).alias("cell"))
        .agg(F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))
    )
    by_time = Window.partitionBy("acc_id").orderBy("cell")
    return (
        cells.withColumn("previous", F.lag("last_ts").over(by_time))
        .withColumn("flag", _gap_flag(F.col("first_ts"), F.col("previous"), gap_minutes))
        .select(
            "acc_id",
            "cell",
            (F.sum("flag").over(by_time) + 1).cast("int").alias("session_no"),
        )
    )


def _cell(cell_seconds: int):
    return F.coalesce(epoch_cell("event_ts", cell_seconds), F.lit(_NO_TIME))


def sessionize(
    events: DataFrame, gap_minutes: int = GAP_MINUTES, cell_seconds: int = CELL_SECONDS
) -> DataFrame:
    """Add ``session_no`` and ``session_id`` in event-time order (null for blank accounts).

    Needs ``acc_id, event_ts, seq``. A row without a time has no place in this order and belongs
    to the account's first session. Rows meet their cell's session in an equi-join, whose
    large partitions AQE can split; no task orders the events of an account.
    """
    cells = session_cells(events, gap_minutes, cell_seconds)
    # Blank accounts match no cell; their own seq spreads them over the join's partitions.
    cell = F.when(is_blank("acc_id"), F.lit(_NO_TIME) - F.col("seq") - 1).otherwise(
        _cell(cell_seconds)
    )
    keyed = events.drop("session_no").withColumn(_CELL, cell)
    cells = cells.withColumnRenamed("cell", _CELL)
    return _named(keyed.join(cells, ["acc_id", _CELL], "left")).drop(_CELL)


def _named(df: DataFrame) -> DataFrame:
    number = F.col("session_no")
    return df.withColumn("session_id", F.when(number.isNotNull(), session_id(number)))


def sessionize_arrival(
    events: DataFrame,
    gap_minutes: int = GAP_MINUTES,
    hot_rows: int = HOT_ROWS,
    span: int = SPAN,
) -> DataFrame:
    """Sessions in arrival order (``seq``), as a stream sees the events.

    A row without a time belongs to the session of the row before it; the next gap is measured
    from the last time there was. A hot account is cut into ranges of ``span`` sequence numbers. Each range is summarised
    by its first and last time and its inner gaps, and a marker row that opens the range
    carries the session number and the last time reached before it.
    """
    events = events.drop("session_no")
    blank = events.where(is_blank("acc_id"))
    known = events.where(~is_blank("acc_id"))
    hot = hot_keys(known, ["acc_id"], hot_rows)
    if hot.isEmpty():
        ranged = known.withColumn(_RANGE, F.lit(0).cast("long"))
        rows = ranged.withColumn(_BASE, F.lit(None).cast("long"))
    else:
        # At most rows / hot_rows keys; the plan decides by their size whether to broadcast.
        flagged = known.join(hot.withColumn(_FLAG, F.lit(True)), "acc_id", "left")
        ranged = flagged.withColumn(
            _RANGE, F.when(F.col(_FLAG), floor_div("seq", span)).otherwise(F.lit(-1))
        ).drop(_FLAG)
        rows = ranged.withColumn(_BASE, F.lit(None).cast("long")).unionByName(
            _range_openers(ranged.where(F.col(_RANGE) >= 0), gap_minutes, span),
            allowMissingColumns=True,
        )
    in_range = Window.partitionBy("acc_id", _RANGE).orderBy("seq")
    flagged = rows.withColumn(_FLAG, _gap_flag(F.col("event_ts"), _time_before(in_range), gap_minutes))
    reached = F.coalesce(F.first(_BASE).over(in_range), F.lit(1)) + F.sum(_FLAG).over(in_range)
    numbered = (
        flagged.withColumn("session_no", reached.cast("int"))
        .where(F.col(_BASE).isNull())
        .drop(_FLAG, _BASE, _RANGE)
    )
    nameless = blank.withColumn("session_no", F.lit(None).cast("int"))
    return _named(numbered.unionByName(nameless))


def _time_before(window: WindowSpec) -> Column:
    """The last time that any earlier row of the window has."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.last("event_ts", ignorenulls=True).over(earlier)


def _range_openers(rows: DataFrame, gap_minutes: int, span: int) -> DataFrame:
    in_range = Window.partitionBy("acc_id", _RANGE).orderBy("seq")
    inner = _gap_flag(F.col("event_ts"), _time_before(in_range), gap_minutes)
    timed = F.when(F.col("event_ts").isNotNull(), F.struct("seq", "event_ts"))
    summary = (
        rows.select("acc_id", _RANGE, "seq", "event_ts", inner.alias(_FLAG))
        .groupBy("acc_id", _RANGE)
        .agg(
            F.min(timed)["event_ts"].alias("head"),
            F.max(timed)["event_ts"].alias("tail"),
            F.sum(_FLAG).alias("gaps"),
        )
    )
    across = Window.partitionBy("acc_id").orderBy(_RANGE)
    so_far = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    edge = _gap_flag(F.col("head"), F.last("tail", ignorenulls=True).over(before), gap_minutes)
    return (
        summary.withColumn("edge", edge)
        .select(
            "acc_id",
            F.lead(_RANGE).over(across).alias(_RANGE),
            F.last("tail", ignorenulls=True).over(so_far).alias("event_ts"),
            (F.sum(F.col("gaps") + F.col("edge")).over(so_far) + 1).alias(_BASE),
        )
        .where(F.col(_RANGE).isNotNull())
        .withColumn("seq", F.col(_RANGE) * span - 1)
    )


def session_totals(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Per account and session: its first and last time, events, and different products.

    For tables, and for streams that carry a watermark on ``event_ts``: there a session is put out
    once no event can extend it any more. A gap of exactly ``gap_minutes`` is no gap, as in
    ``sessionize``. Rows without an account or a time are in no session.
    """
    gap = f"{gap_minutes} minutes"
    known = events.where(~is_blank("acc_id") & F.col("event_ts").isNotNull())
    window = F.session_window("event_ts", gap).alias("session")
    totals = known.groupBy("acc_id", window).agg(
        F.count(F.lit(1)).alias("events"), F.size(F.collect_set("product_id")).cast("bigint").alias("products")
    )
    last = F.col("session.end") - F.make_dt_interval(mins=F.lit(gap_minutes))
    return totals.select(
        "acc_id", F.col("session.start").alias("first_ts"), last.alias("last_ts"), "events", "products"
    )
