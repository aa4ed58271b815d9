"""Purchase intents and their alerts on a stream.

State is keyed by account: the account's live intents by product, and the undiscounted ones again
by the number of the session that they started in. An event discounts all that started in a lesser
session, so whatever waits after it started in its own session or a greater one, and what
it opens itself goes on top: the numbers form a stack, least first. Discounted intents and those
that are too young are never read, however many there are.

Every state access of a Python processor is a message of its own. So an account with at most
``FEW`` live intents keeps all of them in one value, read and written once per micro-batch; one with more
moves them to the maps, of which only what is needed is read, and stays there while it has any.

``open_intents_at`` reads the state of a running, or stopped, query from its checkpoint, and
``stream_alerts`` can start from the snapshot that a batch job left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom import schema as S
from clickloom.functions import is_blank, parse_session_number

_INTENT = (
    "origin string, start_session_id string, start_session_no int, start_time string, "
    "attempts bigint, discounted boolean"
)
_ORIGIN, _SESSION, _NUMBER, _TIME, _ATTEMPTS, _DISCOUNTED = range(6)
# Products that one state value lists.
_LISTED = 64
# Live intents that an account keeps in one value.
FEW = 64
_FEW_COLUMNS = ("product_id", "origin", "start_session_id", "start_session_no", "start_time", "attempts", "discounted")
_FEW_STATE = (
    "product_id array<string>, origin array<string>, start_session_id array<string>, start_session_no array<int>, "
    "start_time array<string>, attempts array<bigint>, discounted array<boolean>"
)
_BATCH = ("seq", "event_type", "product_id", "session_id", "event_time", "session_no")
_Alert = Row(*S.ALERT_COLUMNS)


class _Cached:
    """A map state during one micro-batch: read on demand, written once."""

    def __init__(self, stored) -> None:
        self._stored = stored
        self._known: dict[tuple, tuple | None] = {}
        self._held: dict[tuple, bool] = {}
        self._changed: set[tuple] = set()

    def get(self, *key) -> tuple | None:
        if key not in self._known:
            found = self._stored.getValue(key)
            self._known[key] = None if found is None else tuple(found)
            self._held[key] = found is not None
        return self._known[key]

    def put(self, value: tuple | None, *key) -> None:
        self._known[key] = value
        self._changed.add(key)

    def write(self) -> None:
        for key in self._changed:
            value = self._known[key]
            if value is not None:
                self._stored.updateValue(key, value)
            elif self._held[key] if key in self._held else self._stored.containsKey(key):
                self._stored.removeKey(key)


class _Waiting:
    """Products of undiscounted intents by start session number, the least number first.

    ``levels`` has for every number the next greater one and the number of lists, ``lists`` the
    products. A product stays listed when its intent ends otherwise; whoever takes it looks.
    """

    def __init__(self, levels, lists, head) -> None:
        self._levels, self._lists = _Cached(levels), _Cached(lists)
        self._stored_head = head
        (self._was,) = head.get() or (None,)
        self.head: int | None = self._was

    def add(self, number: int, product: str) -> None:
        above, at = None, self.head
        # Only a snapshot is added out of order; else the first number is not less.
        while at is not None and at < number:
            above, at = at, self._levels.get(at)[0]
        if at != number:
            self._levels.put((at, 1), number)
            self._lists.put(([product],), number, 0)
            if above is None:
                self.head = number
            else:
                self._levels.put((number, self._levels.get(above)[1]), above)
            return
        after, parts = self._levels.get(number)
        products = list((self._lists.get(number, parts - 1) or ((),))[0])
        if len(products) < _LISTED:
            self._lists.put(([*products, product],), number, parts - 1)
        else:
            self._levels.put((after, parts + 1), number)
            self._lists.put(([product],), number, parts)

    def take(self, number: int) -> Iterator[tuple[int, str]]:
        """Remove and return what started in a session less than ``number``."""
        while self.head is not None and self.head < number:
            start = self.head
            self.head, parts = self._levels.get(start)
            self._levels.put(None, start)
            for part in range(parts):
                for product in (self._lists.get(start, part) or ((),))[0]:
                    yield start, product
                self._lists.put(None, start, part)

    def write(self) -> None:
        self._levels.write()
        self._lists.write()
        if self.head != self._was:
            self._stored_head.clear() if self.head is None else self._stored_head.update((self.head,))


class _Few:
    """The live intents of an account that has few, all in memory."""

    def __init__(self, value: tuple | None) -> None:
        lists = value or ((),) * len(_FEW_COLUMNS)
        self.held: dict[str, tuple] = {product: intent for product, *intent in zip(*lists, strict=True)}
        self.held = {product: tuple(intent) for product, intent in self.held.items()}
        self.changed = False

    def get(self, product: str) -> tuple | None:
        return self.held.get(product)

    def put(self, value: tuple | None, product: str) -> None:
        self.changed = True
        if value is None:
            self.held.pop(product, None)
        else:
            self.held[product] = value

    def value(self) -> tuple:
        rows = [(product, *intent) for product, intent in self.held.items()]
        return tuple(list(column) for column in zip(*rows, strict=True))


class _FewWaiting:
    """What ``_Waiting`` is, for intents in memory."""

    def __init__(self, intents: _Few) -> None:
        self._products: dict[int, list[str]] = {}
        for product, intent in intents.held.items():
            if not intent[_DISCOUNTED]:
                self.add(intent[_NUMBER], product)

    def add(self, number: int, product: str) -> None:
        self._products.setdefault(number, []).append(product)

    def take(self, number: int) -> Iterator[tuple[int, str]]:
        for start in sorted(n for n in self._products if n < number):
            for product in self._products.pop(start):
                yield start, product


class IntentTracker(StatefulProcessor):
    def __init__(self, expire_ms: int | None = None) -> None:
        self._expire_ms = expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The lists of products may go with the intents; what holds them together stays.
        ttl = {} if self._expire_ms is None else {"ttlDurationMs": self._expire_ms}
        self._stored = handle.getMapState("intents", "product_id string", _INTENT, **ttl)
        self._levels = handle.getMapState("levels", "session_no int", "above int, parts int")
        self._lists = handle.getMapState("lists", "session_no int, part int", "products array<string>", **ttl)
        self._head = handle.getValueState("head", "session_no int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Rows count in the order of seq, which chunks need not follow; their number is bounded
        # by the source's limit per micro-batch, and seven narrow columns are kept of each.
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        batch["product_id"] = batch["product_id"].astype(object).where(batch["product_id"].notna(), None)
        alerts = self._in_maps(zip(*(batch[c] for c in _BATCH)))
        if alerts:
            yield pd.DataFrame(alerts).assign(acc_id=key[0]).reindex(
                columns=S.ALERT_COLUMNS
            ).astype({"checkout_attempts": "Int64"}).astype(object).where(lambda d: d.notna(), None)

    def _in_maps(self, batch: Iterator[tuple]) -> list[dict]:
        intents, waiting = _Cached(self._stored), _Waiting(self._levels, self._lists, self._head)
        alerts = self._advance(batch, intents, waiting)
        intents.write()
        waiting.write()
        return alerts

    def _advance(self, batch: Iterator[tuple], intents, waiting) -> list[dict]:
        """The alerts of rows in order, whose effects the intents and what waits take."""
        alerts: list[dict] = []
        last = None
        for seq, kind, product, session, time, number in batch:
            number = int(number)
            acts = product is not None and kind in S.ACTING_TYPES
            # Without an effect of its own, a row counts only where the session changes.
            if not acts and number == last:
                continue
            last = number
            self._discount(intents, waiting, seq, session, number, alerts)
            if not acts:
                continue
            before = intents.get(product)
            alert = self._act(intents, kind, product, session, time, number)
            if alert is not None:
                alerts.append({"product_id": product, "seq": seq, **alert})
            opened = intents.get(product)
            # One that waits with the same number already is listed.
            listed = before is not None and not before[_DISCOUNTED] and before[_NUMBER] == number
            if opened is not None and not opened[_DISCOUNTED] and opened is not before and not listed:
                if opened[_NUMBER] == number and (before is None or kind in S.CAPTURE_TYPES):
                    waiting.add(number, product)
        return alerts

    @staticmethod
    def _discount(intents, waiting, seq, session, number: int, alerts: list) -> None:
        """Discount what started in a lesser session."""
        for start, product in waiting.take(number):
            intent = intents.get(product)
            if intent is None or intent[_DISCOUNTED] or intent[_NUMBER] != start:
                continue
            intents.put(intent[:_DISCOUNTED] + (True,), product)
            alerts.append(
                {
                    "alert_type": S.DYNAMIC_PRICING,
                    "product_id": product,
                    "seq": seq,
                    "action": S.PRICING_ACTION,
                    "start_session_id": intent[_SESSION],
                    "current_session_id": session,
                }
            )

    @staticmethod
    def _act(intents, kind, product, session, time, number) -> dict | None:
        intent = intents.get(product)
        fresh = (kind, session, int(number), time, 0, False)
        if kind in S.CAPTURE_TYPES:
            intents.put(fresh, product)
            return {
                "alert_type": S.INTENT_CAPTURED,
                "action": kind,
                "session_id": session,
                "event_time": time,
            }
        if kind == S.CHECKOUT:
            intent = intent or fresh
            attempts = intent[_ATTEMPTS] + 1
            intents.put(intent[:_ATTEMPTS] + (attempts,) + intent[_DISCOUNTED:], product)
            if attempts < 2:
                return None
            return {
                "alert_type": S.CHECKOUT_FRICTION,
                "action": S.FRICTION_ACTION,
                "checkout_attempts": attempts,
            }
        if intent is None:
            return None
        intents.put(None, product)
        if kind == S.PURCHASE:
            return {"alert_type": S.CONVERSION_SUCCESS, "checkout_attempts": intent[_ATTEMPTS]}
        return {"alert_type": S.CART_REMOVED}


class AccountTracker(IntentTracker):
    """``IntentTracker`` on rows, with the intents of accounts that have few in one value.

    With ``expire_ms`` all are in the maps, where each expires on its own.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._few = handle.getValueState("few", _FEW_STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Take over intents that a batch job has left open: one row per account."""
        few = _Few(None)
        for row in initialState["intents"]:
            if row["product_id"] is not None:
                few.put(tuple(row[c] for c in _FEW_COLUMNS[1:]), row["product_id"])
        self._store(few, False)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # As above: the rows of an account in one micro-batch are put in order here.
        rows = list(rows)
        at = [rows[0].__fields__.index(name) for name in _BATCH]
        batch = sorted((tuple(row[k] for k in at) for row in rows), key=lambda r: (r[0] is None, r[0] or 0))
        value = None if self._expire_ms is not None else self._few.get()
        if self._expire_ms is not None or (value is None and self._stored.exists()):
            alerts = self._in_maps(batch)
        else:
            few = _Few(value)
            alerts = self._advance(batch, few, _FewWaiting(few))
            if few.changed:
                self._store(few, value is not None)
        for alert in alerts:
            alert["acc_id"] = key[0]
            yield _Alert(*map(alert.get, S.ALERT_COLUMNS))

    def _store(self, few: _Few, had: bool) -> None:
        if self._expire_ms is None and 0 < len(few.held) <= FEW:
            self._few.update(few.value())
            return
        if had:
            self._few.clear()
        if not few.held:
            return
        intents, waiting = _Cached(self._stored), _Waiting(self._levels, self._lists, self._head)
        for product, intent in sorted(few.held.items(), key=lambda item: -item[1][_NUMBER]):
            intents.put(intent, product)
            if not intent[_DISCOUNTED]:
                waiting.add(intent[_NUMBER], product)
        intents.write()
        waiting.write()


# Columns of ``open_intents`` and their names in the state.
_SNAPSHOT = {
    "origin_action": "origin",
    "start_session_id": "start_session_id",
    "start_session_number": "start_session_no",
    "start_time": "start_time",
    "checkout_attempts": "attempts",
    "discount_applied": "discounted",
}


def stream_alerts(
    events: DataFrame, opened: DataFrame | None = None, expire_ms: int | None = None
) -> DataFrame:
    """Streaming form of ``pricing_alerts``, same columns.

    Intents live until they are closed. There is no watermark: events count in ``seq``
    order, however old their event time. ``opened``, rows of ``open_intents`` over all earlier
    events, is taken over by the first run of a checkpoint. With ``expire_ms`` an intent that has not
    changed for so long, by the clock, is forgotten: it raises no alert and leaves the state. That
    needs a query with an interval: one over all that is available has no clock to end by.
    """
    product = F.when(~is_blank("product_id"), F.col("product_id"))
    keyed = events.where(~is_blank("acc_id")).select(
        "acc_id",
        F.col("seq").cast("long").alias("seq"),
        "event_type",
        product.alias("product_id"),
        "session_id",
        "event_time",
        parse_session_number("session_id").alias("session_no"),
    )
    initial = None
    if opened is not None:
        state = [F.col(name).alias(own) for name, own in _SNAPSHOT.items()]
        intents = F.collect_list(F.struct("product_id", *state)).alias("intents")
        initial = opened.groupBy("acc_id").agg(intents).groupBy("acc_id")
    return keyed.groupBy("acc_id").transformWithState(
        AccountTracker(expire_ms), S.ALERT_SCHEMA, outputMode="Append",
        timeMode="None" if expire_ms is None else "ProcessingTime", initialState=initial,
    )


def open_intents_at(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The intents that are live in the state of a query of ``stream_alerts``, as ``open_intents``
    gives them: after its last micro-batch, or after ``batch_id``. The query may be running."""

    def read(variable: str) -> DataFrame:
        reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable)
        return (reader if batch_id is None else reader.option("batchId", batch_id)).load()

    state = F.col("user_map_value")
    many = read("intents").select(
        F.col("key.acc_id").alias("acc_id"),
        F.col("user_map_key.product_id").alias("product_id"),
        *(state[own].alias(name) for name, own in _SNAPSHOT.items()),
    )
    kept = spark.read.format("state-metadata").load(checkpoint).select("operatorProperties").collect()
    if not any('"few"' in (row[0] or "") for row in kept):
        # Of a query of ``IntentTracker``.
        return many
    few = F.arrays_zip(*(F.col(f"value.{c}").alias(c) for c in _FEW_COLUMNS))
    few = read("few").select(F.col("key.acc_id").alias("acc_id"), F.inline(few).alias(*_FEW_COLUMNS))
    named = (F.col(own).alias(name) for name, own in _SNAPSHOT.items())
    return many.unionByName(few.select("acc_id", "product_id", *named))
