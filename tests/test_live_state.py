"""State of running streams: read from outside, started from a batch, and no slower with what it need not read."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from clickloom import schema as S
from clickloom.operators import dashboards, intents
from clickloom.operators.sessions import sessionize_arrival
from clickloom.sources import tables
from clickloom.streaming import (
    final_minutes,
    open_intents_at,
    sessions_reached,
    start_table,
    stream_alerts,
    stream_sessions,
    use_rocksdb_state,
)
from clickloom.streaming import intents as live
from clickloom.streaming.intents import AccountTracker, IntentTracker
from tests.model import EVENT_FIELDS, blank, messy_events, session_number, track


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    use_rocksdb_state(spark)


def run(query):
    query.awaitTermination()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def split_stream(spark, path, rows, parts):
    """The rows as files of rising seq, read one per micro-batch."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        piece = spark.createDataFrame(rows[k * size : (k + 1) * size], EVENT_FIELDS)
        piece.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT_FIELDS).option("maxFilesPerTrigger", 1).parquet(path)


def test_open_intents_of_a_stream(spark, tmp_path):
    """After the last batch and one batch back, against the sequential model."""
    rows = messy_events(11, size=240)
    stream = split_stream(spark, str(tmp_path / "in"), rows, 3)
    checkpoint = str(tmp_path / "cp")
    run(start_table(stream_alerts(stream), str(tmp_path / "out"), checkpoint))
    assert rows_of(open_intents_at(spark, checkpoint)) == track(rows)[1]
    assert rows_of(open_intents_at(spark, checkpoint, 1)) == track(rows[:160])[1]
    batch = intents.open_intents(spark.createDataFrame(rows, EVENT_FIELDS))
    assert rows_of(open_intents_at(spark, checkpoint).select(batch.columns)) == rows_of(batch)


@pytest.mark.parametrize("seed", [21, 22])
def test_alerts_from_batch_to_stream(spark, tmp_path, seed):
    """The first half by a batch job, the second by a stream that takes over its intents."""
    rows = messy_events(seed, size=240)
    first = spark.createDataFrame(rows[:120], EVENT_FIELDS)
    stream = split_stream(spark, str(tmp_path / "in"), rows[120:], 2)
    checkpoint = str(tmp_path / "cp")
    alerts = stream_alerts(stream, intents.open_intents(first))
    run(start_table(alerts, str(tmp_path / "out"), checkpoint))
    want, opened = track(rows)
    got = intents.pricing_alerts(first).unionByName(spark.read.parquet(str(tmp_path / "out")))
    assert rows_of(got) == want
    # Accounts that the stream has not seen are in its state as well.
    assert rows_of(open_intents_at(spark, checkpoint)) == opened


def test_sessions_from_batch_to_stream(spark, sf_dir, tmp_path):
    events = tables.unsessioned_events(spark, sf_dir)
    events = events.withColumn("event_ts", F.when(F.col("seq") % 7 != 0, F.col("event_ts")))
    half = events.agg(F.max("seq")).first()[0] // 2
    source = str(tmp_path / "in")
    later = events.where(F.col("seq") > half)
    for part in (F.col("seq") <= half * 3 // 2, F.col("seq") > half * 3 // 2):
        later.where(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(later.schema).option("maxFilesPerTrigger", 1).parquet(source)
    first = sessionize_arrival(events.where(F.col("seq") <= half))
    numbered = stream_sessions(stream, reached=sessions_reached(first))
    run(start_table(numbered, str(tmp_path / "out"), str(tmp_path / "cp")))
    columns = ["acc_id", "seq", "session_id", "session_no"]
    got = first.select(columns).unionByName(spark.read.parquet(str(tmp_path / "out")).select(columns))
    assert rows_of(got) == rows_of(sessionize_arrival(events).select(columns))


class Map:
    """A map state in memory that counts what is read."""

    def __init__(self):
        self.held, self.reads = {}, 0

    def getValue(self, key):
        self.reads += 1
        return self.held.get(tuple(key))

    def containsKey(self, key):
        return tuple(key) in self.held

    def updateValue(self, key, value):
        self.held[tuple(key)] = value

    def removeKey(self, key):
        del self.held[tuple(key)]

    def iterator(self):
        raise AssertionError("the whole state is never read")


class Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Map())

    def getValueState(self, name, *_):
        return self.states.setdefault(name, Value())

    def reads(self):
        return sum(s.reads for s in self.states.values() if isinstance(s, Map))


def fed(tracker, rows):
    frame = pd.DataFrame(rows, columns=["product_id", "event_type", "session_id", "event_time", "seq", "session_no"])
    out = list(tracker.handleInputRows(("A",), iter([frame]), None))
    return [tuple(r) for f in out for r in f.itertuples(index=False)]


def tracker_with_discounted(number):
    """An account with that many discounted intents, and its state."""
    handle, tracker = Handle(), IntentTracker()
    tracker.init(handle)
    fed(tracker, [(f"P{k}", "ADD_TO_CART", "S1", "t", k, 1) for k in range(number)])
    alerts = fed(tracker, [(None, "VIEW", "S2", "t", number, 2)])
    assert sum(a[0] == "DYNAMIC_PRICING" for a in alerts) == number
    assert len(handle.states["intents"].held) == number
    return handle, tracker


def test_discounted_intents_are_not_read_again():
    counts = []
    for number in (10, 10_000):
        handle, tracker = tracker_with_discounted(number)
        before = handle.reads()
        for step in range(3, 30):
            fed(tracker, [("Q", "ADD_TO_CART", f"S{step}", "t", number + step, step)])
        counts.append(handle.reads() - before)
    assert counts[0] == counts[1] < 27 * 6


def test_young_intents_are_not_read():
    """Many intents wait with a number above that of the events that follow."""
    handle, tracker = Handle(), IntentTracker()
    tracker.init(handle)
    fed(tracker, [(f"P{k}", "WISHLIST", "S9", "t", k, 9) for k in range(5_000)])
    before = handle.reads()
    assert fed(tracker, [(None, "VIEW", "S3", "t", 6_000, 3)]) == []
    assert handle.reads() == before


@pytest.mark.parametrize("seed", range(12))
def test_tracker_equals_the_model(seed):
    """Many products, sessions that step back, batches of any size; states in memory."""
    rng = random.Random(seed)
    rows = [r for r in messy_events(seed, size=600, accounts=1, products=12) if r[0] and r[0].strip()]
    handle, tracker = Handle(), IntentTracker()
    tracker.init(handle)
    got, at = [], 0
    while at < len(rows):
        size = rng.randrange(1, 40)
        part = [(None if blank(p) else p, k, s, t, q, session_number(s)) for _, p, k, s, t, q in rows[at : at + size]]
        got += fed(tracker, part)
        at += size
    want, opened = track(rows)
    clean = [tuple(None if v is None or v is pd.NA or v != v else v for v in r) for r in got]
    assert sorted(((a[0], a[2], a[3]) for a in clean), key=repr) == sorted(((a[0], a[2], a[3]) for a in want), key=repr)
    assert len(handle.states["intents"].held) == len(opened)


@pytest.mark.parametrize("expire_ms", [None, 1])
def test_expiry(spark, tmp_path, expire_ms):
    """Off: as ever. On: an intent of the batch before raises no alert."""
    source = str(tmp_path / "in")
    halves = [[("A", "P", "ADD_TO_CART", "SS1", "t", 1), ("A", "Q", "WISHLIST", "SS1", "t", 2)],
              [("A", "R", "ADD_TO_CART", "SS2", "t", 3), ("A", "P", "PURCHASE", "SS2", "t", 4)]]
    query, seen = None, 0
    for half in halves:
        spark.createDataFrame(half, EVENT_FIELDS).coalesce(1).write.mode("append").parquet(source)
        seen += len(half)
        if query is None:
            stream = spark.readStream.schema(EVENT_FIELDS).parquet(source)
            alerts = stream_alerts(stream, expire_ms=expire_ms)
            query = start_table(alerts, str(tmp_path / "out"), str(tmp_path / "cp"), "1 second")
        until = time.time() + 60
        while sum(p["numInputRows"] for p in query.recentProgress) < seen and time.time() < until:
            time.sleep(0.2)
    query.stop()
    kinds = sorted(r.alert_type for r in spark.read.parquet(str(tmp_path / "out")).collect())
    more = [] if expire_ms else ["CONVERSION_SUCCESS", "DYNAMIC_PRICING", "DYNAMIC_PRICING"]
    assert kinds == [*more, *["INTENT_CAPTURED"] * 3]


def test_final_minutes_and_late_rows(spark, sf_dir, tmp_path):
    """Events out of order: final minutes and late rows are the velocity, once each."""
    events = tables.unsessioned_events(spark, sf_dir).select("event_ts", "seq").cache()
    source = str(tmp_path / "in")
    bounds = events.selectExpr("percentile(unix_micros(event_ts), array(0.3, 0.6, 1.0))").first()[0]
    low = -1
    for number, high in enumerate(bounds):
        inside = (F.unix_micros("event_ts") > low) & (F.unix_micros("event_ts") <= high) & (F.col("seq") % 9 != 0)
        # One event of nine comes with the last part.
        part = events.where(inside if number < 2 else inside | (F.col("seq") % 9 == 0))
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        run(start_table(final_minutes(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
        low = high
    out = spark.read.parquet(str(tmp_path / "out"))
    late = [r.seq for r in out.where("kind = 'late'").collect()]
    assert len(late) == len(set(late)) > 10 and all(s % 9 == 0 for s in late)
    end = events.agg(F.max("event_ts")).first()[0]
    closed = F.col("minute") <= F.lit(end) - F.expr("interval 11 minutes")
    got = out.where(closed).groupBy("minute").agg(F.sum("events").alias("events"))
    want = dashboards.ingestion_velocity(events).where(closed)
    assert rows_of(got) == rows_of(want)
    per_part = out.where("kind = 'final'").groupBy("minute").count()
    assert per_part.where("count > 64").count() == 0


class Counted:
    """States in memory that count every access to them, as each is a message."""

    def __init__(self):
        self.states, self.accesses = {}, 0

    def _add(self, name, state):
        for method in ("getValue", "containsKey", "updateValue", "removeKey", "exists", "get", "update", "clear"):
            if hasattr(state, method):
                setattr(state, method, self._counting(getattr(state, method)))
        return self.states.setdefault(name, state)

    def _counting(self, method):
        def call(*arguments):
            self.accesses += 1
            return method(*arguments)

        return call

    def getMapState(self, name, *_):
        state = Map()
        state.exists = lambda: bool(state.held)
        return self._add(name, state)

    def getValueState(self, name, *_):
        return self._add(name, Value())

    def opened(self):
        few = zip(*(self.states["few"].held or ()))
        return sorted([*((p, *i) for (p,), i in self.states["intents"].held.items()), *few], key=repr)


def fed_rows(tracker, rows):
    shape = Row("acc_id", "product_id", "event_type", "session_id", "event_time", "seq", "session_no")
    part = [shape(a, None if blank(p) else p, k, s, t, q, session_number(s)) for a, p, k, s, t, q in rows]
    return list(tracker.handleInputRows(("A",), iter(part), None))


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("few", [3, 6, 64])
def test_account_tracker_equals_the_model(monkeypatch, seed, few):
    """Accounts that grow beyond what one value holds, shrink to nothing and grow again."""
    monkeypatch.setattr(live, "FEW", few)
    rng = random.Random(seed)
    rows = [("A", *r[1:]) for r in messy_events(seed, size=600, accounts=1, products=12) if r[0] and r[0].strip()]
    held = sorted({r[1] for r in rows if not blank(r[1])})
    half = len(rows) // 2
    closing = [("A", p, "PURCHASE", rows[half][3], "t", rows[half - 1][5] + (k + 1) / 100) for k, p in enumerate(held)]
    rows = sorted([*rows, *closing], key=lambda r: r[5])
    handle, tracker = Counted(), AccountTracker()
    tracker.init(handle)
    got, at, forms = [], 0, set()
    while at < len(rows):
        size = rng.randrange(1, 40)
        part = rows[at : at + size]
        rng.shuffle(part)
        got += fed_rows(tracker, part)
        forms |= {name for name in ("few", "intents") if handle.states[name].held}
        assert not (handle.states["few"].held and handle.states["intents"].held)
        at += size
    want, opened = track(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert handle.opened() == sorted((r[1:] for r in opened), key=repr)
    assert {3: "intents", 6: min(forms), 64: "few"}[few] in forms


def test_few_intents_take_few_accesses():
    handle, tracker = Counted(), AccountTracker()
    tracker.init(handle)
    for step in range(20):
        rows = [("A", f"P{k}", "ADD_TO_CART", f"S{step}", "t", 100 * step + k) for k in range(30)]
        before = handle.accesses
        alerts = fed_rows(tracker, rows)
        assert len(alerts) == (60 if step else 30)
        assert handle.accesses - before <= 3


def test_accounts_with_few_and_with_many_intents(spark, tmp_path):
    """Through the state of Spark, read in between; 90 products are more than one value holds."""
    kinds = ("ADD_TO_CART", "WISHLIST", "CHECKOUT", "VIEW", "PURCHASE")
    rng = random.Random(3)
    rows = [
        (acc, f"P{rng.randrange(number)}", kinds[rng.randrange(2 if k < 300 else 5)], f"SS{k // 60}", "t", k)
        for k in range(600) for acc, number in (("few", 9), ("many", 90))
    ]
    stream = split_stream(spark, str(tmp_path / "in"), rows, 3)
    checkpoint = str(tmp_path / "cp")
    run(start_table(stream_alerts(stream), str(tmp_path / "out"), checkpoint))
    want, opened = track(rows)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == want
    assert rows_of(open_intents_at(spark, checkpoint)) == opened
    assert rows_of(open_intents_at(spark, checkpoint, 0)) == track(rows[:400])[1]
    state = spark.read.format("statestore").option("path", checkpoint)
    states = [state.option("stateVarName", name).load() for name in ("few", "intents")]
    assert [{r.key.acc_id for r in s.collect()} for s in states] == [{"few"}, {"many"}]


def test_open_intents_of_a_checkpoint_without_values(spark, tmp_path):
    """A query of ``IntentTracker``, as there were before, has the maps only."""
    rows = [("A", f"P{k}", "ADD_TO_CART", "SS1", "t", k) for k in range(5)]
    stream = split_stream(spark, str(tmp_path / "in"), rows, 1)
    keyed = stream.withColumn("session_no", F.lit(1)).groupBy("acc_id")
    alerts = keyed.transformWithStateInPandas(IntentTracker(), S.ALERT_SCHEMA, outputMode="Append", timeMode="None")
    checkpoint = str(tmp_path / "cp")
    run(start_table(alerts, str(tmp_path / "out"), checkpoint))
    assert rows_of(open_intents_at(spark, checkpoint)) == track(rows)[1]
