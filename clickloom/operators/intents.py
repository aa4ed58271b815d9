"""Purchase intents per (account, product) as windows over the events that act on them.

An intent is opened, or opened anew, by ADD_TO_CART and WISHLIST, and by a CHECKOUT where
none is live; every CHECKOUT counts as an attempt; PURCHASE and REMOVE_FROM_CART close it.
All of it follows ``seq``. Input columns: ``acc_id, product_id, event_type, session_id,
event_time, seq``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom import schema as S
from clickloom.functions import floor_div, is_blank, parse_session_number
from clickloom.operators.pricing import first_greater_after, session_summary
from clickloom.plans import HOT_ROWS, SPAN, small_or_shuffled, stage

# A session summary of at most this content is sent to every task.
SUMMARY_BYTES = 32 * 1024 * 1024

_ENDED = "ENDED"
_STALE = "STALE"
_ENTER = "ENTER"
_ENTER_LIVE = "ENTER_LIVE"
_EXIT = "EXIT"

_PAIR = ["acc_id", "product_id"]
INPUT_COLUMNS = (*_PAIR, "event_type", "session_id", "event_time", "seq")
_START_TYPE = (
    "struct<seq: bigint, origin: string, session_id: string, session_no: int, "
    "event_time: string, base: bigint>"
)


def acting_events(events: DataFrame) -> DataFrame:
    """Events that can change an intent: acting type, account and product present."""
    return events.where(
        F.col("event_type").isin(*S.ACTING_TYPES)
        & ~is_blank("acc_id")
        & ~is_blank("product_id")
    ).select(
        *_PAIR,
        F.col("seq").cast("long").alias("seq"),
        "event_type",
        "session_id",
        "event_time",
        parse_session_number("session_id").alias("session_no"),
    )


def _is(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def _start(base: Column) -> Column:
    """The intent this row would open; ``base`` is the checkout count it starts from."""
    return F.struct(
        F.col("seq").alias("seq"),
        F.col("event_type").alias("origin"),
        F.col("session_id").alias("session_id"),
        F.col("session_no").alias("session_no"),
        F.col("event_time").alias("event_time"),
        base.alias("base"),
    ).cast(_START_TYPE)


def _with_ranges(acting: DataFrame, hot: DataFrame | None, span: int) -> DataFrame:
    """Cut the hot accounts, or pairs, into sequence ranges joined up by marker rows.

    ``hot``, a staged table, is broadcast if it measures small.
    """
    rows = acting.withColumn("carried", F.lit(None).cast(_START_TYPE))
    if hot is None:
        return rows.withColumn("range", F.lit(-1).cast("long"))
    flagged = rows.join(small_or_shuffled(hot).withColumn("is_hot", F.lit(True)), hot.columns, "left")
    ranged = flagged.withColumn(
        "range", F.when(F.col("is_hot"), floor_div("seq", span)).otherwise(F.lit(-1))
    ).drop("is_hot")
    markers = _range_markers(ranged.where(F.col("range") >= 0).drop("carried"), span)
    return ranged.unionByName(markers, allowMissingColumns=True)


def _range_markers(rows: DataFrame, span: int) -> DataFrame:
    """An ENTER row with the state a range starts in, and an EXIT row where one follows.

    A range acts on the state before it either by its last resetting event and the checkouts
    after that, or, without a resetting event, by its checkouts alone. That is one summary
    row per range, folded along the ranges of the pair.
    """
    whole = Window.partitionBy(*_PAIR, "range")
    resets = _is(*S.CAPTURE_TYPES, *S.CLOSING_TYPES)
    tail_checkout = _is(S.CHECKOUT) & (
        F.col("last_reset").isNull() | (F.col("seq") > F.col("last_reset.seq"))
    )
    start = _start(F.lit(0).cast("long"))
    summary = (
        rows.withColumn("last_reset", F.max(F.when(resets, start)).over(whole))
        .groupBy(*_PAIR, "range")
        .agg(
            F.first("last_reset").alias("last_reset"),
            F.count(F.when(tail_checkout, 1)).alias("checkouts"),
            F.min(F.when(tail_checkout, start)).alias("first_checkout"),
        )
    )
    along = Window.partitionBy(*_PAIR).orderBy("range")
    stretch = (
        Window.partitionBy(*_PAIR, "stretch")
        .orderBy("range")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reset = F.first("last_reset").over(stretch)
    folded = (
        summary.withColumn("stretch", F.count("last_reset").over(along))
        .withColumn("reset", reset)
        .withColumn("attempts", F.sum("checkouts").over(stretch))
        .withColumn("checkout", F.first("first_checkout", ignorenulls=True).over(stretch))
        .withColumn("next_range", F.lead("range").over(along))
        .where(F.col("next_range").isNotNull())
    )
    state = F.when(F.col("reset.origin").isin(*S.CAPTURE_TYPES), F.col("reset")).otherwise(
        F.col("checkout")
    )
    state = F.when(state.isNotNull(), state.withField("base", -F.col("attempts")))
    enter = F.struct(
        F.col("next_range").alias("range"),
        (F.col("next_range") * span - 1).alias("seq"),
        F.when(state.isNotNull(), _ENTER_LIVE).otherwise(_ENTER).alias("event_type"),
        state.cast(_START_TYPE).alias("carried"),
    )
    leave = F.struct(
        F.col("range"),
        ((F.col("range") + 1) * span).alias("seq"),
        F.lit(_EXIT).alias("event_type"),
        F.lit(None).cast(_START_TYPE).alias("carried"),
    )
    return folded.select(*_PAIR, F.inline(F.array(enter, leave)))


def _life_cycle(rows: DataFrame) -> DataFrame:
    """Per acting row: the intent before and after it, and the attempts counted."""
    by_seq = Window.partitionBy(*_PAIR, "range").orderBy("seq")
    so_far = by_seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_seq.rowsBetween(Window.unboundedPreceding, -1)
    is_checkout = _is(S.CHECKOUT)
    stepped = rows.withColumns(
        {
            "previous_type": F.lag("event_type").over(by_seq),
            "is_last": F.lead("seq").over(by_seq).isNull(),
            "checkouts": F.count(F.when(is_checkout, 1)).over(so_far),
        }
    )
    live_before = F.coalesce(
        F.col("previous_type").isin(*S.CAPTURE_TYPES, S.CHECKOUT, _ENTER_LIVE), F.lit(False)
    )
    opens = _is(*S.CAPTURE_TYPES) | (is_checkout & ~live_before)
    counted = F.col("checkouts") - is_checkout.cast("long")
    opened = F.when(opens, _start(counted)).otherwise(F.col("carried"))
    started = stepped.withColumns({"live_before": live_before, "opened": opened}).withColumn(
        "start_before", F.last("opened", ignorenulls=True).over(before)
    )
    start_after = F.coalesce("opened", "start_before")
    return started.where(~_is(_ENTER, _ENTER_LIVE, _EXIT)).withColumns(
        {
            "start_after": start_after,
            "attempts_before": counted - F.col("start_before.base"),
            "attempts_after": F.col("checkouts") - start_after["base"],
        }
    )


def _without_sessions(events: DataFrame, hot_rows: int, span: int) -> DataFrame:
    """Life cycle without the account's other sessions, for the branch alerts."""
    acting = acting_events(events)
    # The windows are over pairs, so pairs are counted, among the rows that act.
    counts = acting.groupBy(*_PAIR).agg(F.count(F.lit(1)).alias("rows"))
    (most,) = counts.agg(F.max("rows")).first()
    return _life_cycle(_with_ranges(acting, _above(counts, most, hot_rows), span))


def _above(counts: DataFrame, most: int | None, hot_rows: int) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows, staged; None, without a job, if none has."""
    if (most or 0) <= hot_rows:
        return None
    return stage(counts.where(F.col("rows") > hot_rows).drop("rows"))


class _Sessions(NamedTuple):
    """What lies beyond each session, whether that is small, and whether any account steps back."""

    greater: DataFrame
    small: bool
    steps_back: bool


def _with_sessions(events: DataFrame, hot_rows: int, span: int) -> tuple[DataFrame, _Sessions]:
    """Life cycle, and the account's sessions that its intents are to be held against.

    The session summary is staged: what one job over it finds decides whether the plan needs
    ranges for hot accounts, a search for accounts that step back, and a shuffle to meet
    the summary. Most inputs need neither of the first two.
    """
    summary = stage(session_summary(events))
    accounts = summary.groupBy("acc_id").agg(
        F.sum("rows").alias("rows"),
        F.max("steps_back").alias("steps_back"),
        F.sum(F.lit(64) + F.octet_length("acc_id") + _octets("greater.first_session_id")).alias("bytes"),
    )
    most, steps_back, size = accounts.agg(F.max("rows"), F.max("steps_back"), F.sum("bytes")).first()
    hot = _above(accounts.select("acc_id", "rows"), most, hot_rows)
    rows = _life_cycle(_with_ranges(acting_events(events), hot, span))
    greater = summary.select("acc_id", "session_no", "greater")
    small = (size or 0) <= SUMMARY_BYTES
    return rows, _Sessions(F.broadcast(greater) if small else greater, small, bool(steps_back))


def _octets(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0))


# Columns of an unfolded record after ``alert_type``; the last three serve ended intents.
_RECORD_FIELDS = {
    "seq": "bigint",
    "action": "string",
    "session_id": "string",
    "event_time": "string",
    "checkout_attempts": "bigint",
    "start_session_id": "string",
    "current_session_id": "string",
    "start_seq": "bigint",
    "end_seq": "bigint",
    "session_no": "int",
}


def _record(kind: str, when: str, **values: str) -> Column:
    """A record of ``kind`` where ``when`` holds, its fields given as SQL expressions."""
    fields = ", ".join(
        f"cast({values.get(name, 'null')} as {of}) as {name}"
        for name, of in _RECORD_FIELDS.items()
    )
    return F.expr(f"case when {when} then struct('{kind}' as alert_type, {fields}) end")


def _among(kinds: tuple[str, ...]) -> str:
    return "event_type in ({})".format(", ".join(f"'{kind}'" for kind in kinds))


_BRANCHES = {
    S.INTENT_CAPTURED: (
        _among(S.CAPTURE_TYPES),
        {
            "seq": "seq",
            "action": "event_type",
            "session_id": "session_id",
            "event_time": "event_time",
        },
    ),
    S.CHECKOUT_FRICTION: (
        f"event_type = '{S.CHECKOUT}' and attempts_after >= 2",
        {
            "seq": "seq",
            "action": f"'{S.FRICTION_ACTION}'",
            "checkout_attempts": "attempts_after",
        },
    ),
    S.CONVERSION_SUCCESS: (
        f"event_type = '{S.PURCHASE}' and live_before",
        {"seq": "seq", "checkout_attempts": "attempts_before"},
    ),
    S.CART_REMOVED: (
        f"event_type = '{S.REMOVE_FROM_CART}' and live_before",
        {"seq": "seq"},
    ),
}

# When an intent ends and its end: at the closing or overwriting event, which itself still
# counts because the check comes before the event's effect, or not at all.
_ENDS = {
    "start_before": (f"live_before and {_among(S.CAPTURE_TYPES + S.CLOSING_TYPES)}", "seq"),
    "start_after": (f"is_last and {_among(S.CAPTURE_TYPES + (S.CHECKOUT,))}", "null"),
}


def _branch(kind: str) -> Column:
    when, values = _BRANCHES[kind]
    return _record(kind, when, **values)


def _ended(state: str) -> Column:
    """The intent at its end: what lies beyond its session decides about a discount."""
    when, end = _ENDS[state]
    return _record(
        _ENDED,
        when,
        start_seq=f"{state}.seq",
        end_seq=end,
        session_no=f"{state}.session_no",
        start_session_id=f"{state}.session_id",
    )


def _judged(records: DataFrame, greater: DataFrame) -> DataFrame:
    """Ended intents become discounts or, where the first must still be found, stale; or they go.

    The first event of a greater session after the start, and not after the end, sets off the
    discount. It may lie before the start while others lie after: then the first of those must be
    searched, which only happens in accounts that step back. Other records stay as they are.
    """
    kind = F.col("alert_type")
    first, start = F.col("greater.first_seq"), F.col("start_seq")
    until = F.coalesce("end_seq", first)
    discount = (kind == _ENDED) & (first > start) & (first <= until)
    stale = (kind == _ENDED) & (first < start) & (F.col("greater.last_seq") > start)
    judged = (
        F.when(discount, S.DYNAMIC_PRICING).when(stale, _STALE).when(kind != _ENDED, kind)
    )
    session = F.col("greater.first_session_id")
    return (
        records.join(greater, ["acc_id", "session_no"], "left")
        .withColumns(
            {
                "alert_type": judged,
                "seq": F.when(discount, first).otherwise(F.col("seq")),
                "action": F.when(discount, F.lit(S.PRICING_ACTION)).otherwise(F.col("action")),
                "current_session_id": F.when(discount, session),
                "top_no": F.col("greater.top_no"),
            }
        )
        .where(kind.isNotNull())
        .drop("greater")
    )


def _unfold(rows: DataFrame, records: list[Column]) -> DataFrame:
    return rows.select(*_PAIR, F.inline(F.array_compact(F.array(*records))))


def intents_captured(events: DataFrame) -> DataFrame:
    """Every ADD_TO_CART and WISHLIST opens an intent; no state is needed to see it."""
    acting = acting_events(events).where(_is(*S.CAPTURE_TYPES))
    return _unfold(acting, [_branch(S.INTENT_CAPTURED)]).select(*S.ALERT_COLUMNS)


def checkout_attempts(
    events: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN
) -> DataFrame:
    """Each CHECKOUT with the number of attempts its intent has reached."""
    rows = _without_sessions(events, hot_rows, span)
    return rows.where(_is(S.CHECKOUT)).select(
        *_PAIR,
        "seq",
        F.col("attempts_after").alias("checkout_attempts"),
        F.col("start_after.origin").alias("origin_action"),
    )


def branch_alerts(
    events: DataFrame, kind: str, hot_rows: int = HOT_ROWS, span: int = SPAN
) -> DataFrame:
    """CHECKOUT_FRICTION, CONVERSION_SUCCESS or CART_REMOVED alerts."""
    rows = _without_sessions(events, hot_rows, span)
    return _unfold(rows, [_branch(kind)]).select(*S.ALERT_COLUMNS)


def open_intents(events: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """Snapshot of the intents still live after the last event.

    One is discounted when any event of a greater session lies after its start.
    """
    rows, sessions = _with_sessions(events, hot_rows, span)
    live_after, _ = _ENDS["start_after"]
    start = F.col("start_after")
    live = rows.where(live_after).select(
        *_PAIR,
        start["origin"].alias("origin_action"),
        start["session_id"].alias("start_session_id"),
        start["session_no"].alias("session_no"),
        start["event_time"].alias("start_time"),
        F.col("attempts_after").alias("checkout_attempts"),
        start["seq"].alias("start_seq"),
    )
    passed = F.col("greater.last_seq") > F.col("start_seq")
    return live.join(sessions.greater, ["acc_id", "session_no"], "left").select(
        *_PAIR,
        "origin_action",
        "start_session_id",
        F.col("session_no").alias("start_session_number"),
        "start_time",
        "checkout_attempts",
        F.coalesce(passed, F.lit(False)).alias("discount_applied"),
    )


def _alerts(events: DataFrame, kinds: list[str], hot_rows: int, span: int) -> DataFrame:
    rows, sessions = _with_sessions(events, hot_rows, span)
    records = _unfold(rows, [_branch(kind) for kind in kinds] + [_ended(state) for state in _ENDS])
    kind = F.col("alert_type")
    if sessions.small or not kinds:
        judged = _judged(records, sessions.greater)
    else:
        # Only intents that end are shuffled to meet their sessions, all else stays in place.
        records = stage(records)
        judged = _judged(records.where(kind == _ENDED), sessions.greater).unionByName(
            records.where(kind != _ENDED), allowMissingColumns=True
        )
    if not sessions.steps_back:
        return judged.select(*S.ALERT_COLUMNS)
    judged = stage(judged)
    found = first_greater_after(judged.where(kind == _STALE), events, span).select(
        F.lit(S.DYNAMIC_PRICING).alias("alert_type"),
        *_PAIR,
        "seq",
        F.lit(S.PRICING_ACTION).alias("action"),
        "start_session_id",
        "current_session_id",
    )
    alerts = judged.where(kind != _STALE).select(*S.ALERT_COLUMNS)
    return alerts.unionByName(found, allowMissingColumns=True)


def dynamic_pricing(events: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """Discounts: the first event of a later session while an intent is live, once per intent."""
    return _alerts(events, [], hot_rows, span)


def pricing_alerts(events: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """All five alert kinds."""
    return _alerts(events, list(_BRANCHES), hot_rows, span)
