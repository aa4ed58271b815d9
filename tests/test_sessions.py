import random
from datetime import datetime, timedelta, timezone

import pytest

from clickloom.operators.sessions import sessionize, sessionize_arrival
from tests.model import sessions

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame(
        [(acc, START + timedelta(seconds=s), seq) for acc, s, seq in rows],
        "acc_id string, event_ts timestamp, seq long",
    )


def numbers(df):
    return {r.seq: r.session_no for r in df.collect()}


def test_gap_must_be_longer_than_fifteen_minutes(spark):
    rows = [("A", 0, 1), ("A", 900, 2), ("A", 1800.000001, 3)]
    got = sessionize(frame(spark, rows)).orderBy("seq").collect()
    assert [r.session_id for r in got] == ["SS00000001", "SS00000001", "SS00000002"]
    assert numbers(sessionize_arrival(frame(spark, rows))) == {1: 1, 2: 1, 3: 2}


@pytest.mark.parametrize("cell_seconds", [1, 60, 900])
def test_time_order(spark, cell_seconds):
    rng = random.Random(cell_seconds)
    rows = [(rng.choice(["A", "B", "C", "", None]), rng.randint(0, 60000) / 2, i)
            for i in range(400)]
    want = sessions(sorted(rows, key=lambda r: (r[1], r[2])))
    assert numbers(sessionize(frame(spark, rows), cell_seconds=cell_seconds)) == want


def test_cells_may_not_exceed_the_timeout(spark):
    with pytest.raises(ValueError):
        sessionize(frame(spark, [("A", 0, 1)]), cell_seconds=901)


@pytest.mark.parametrize("hot_rows, span", [(10**9, 10**9), (50, 37), (0, 1), (0, 10)])
def test_arrival_order(spark, hot_rows, span):
    rng = random.Random(span)
    rows, clock = [], 0
    for i in range(300):
        clock += rng.choice([-2000, 60, 800, 901, 1200])
        rows.append((rng.choice(["A", "A", "A", "B", "", None]), clock, i))
    got = sessionize_arrival(frame(spark, rows), hot_rows=hot_rows, span=span)
    assert numbers(got) == sessions(rows)


def test_both_orders_agree_on_ordered_input(spark):
    rows = [("A", i * 500, i) for i in range(50)]
    assert numbers(sessionize(frame(spark, rows))) == numbers(
        sessionize_arrival(frame(spark, rows), hot_rows=5, span=7))


@pytest.mark.parametrize("hot_rows, span", [(10**9, 10**9), (0, 3), (0, 50)])
def test_rows_without_a_time_in_arrival_order(spark, hot_rows, span):
    rng = random.Random(span)
    rows, clock = [], 0
    for i in range(200):
        clock += rng.choice([60, 800, 901, 1200])
        rows.append((rng.choice(["A", "A", "B", ""]), clock if rng.random() < 0.7 else None, i))
    want, state = {}, {}
    for acc, at, seq in rows:
        if not acc:
            want[seq] = None
            continue
        number, last = state.get(acc, (1, None))
        if at is not None:
            number += last is not None and at - last > 900
            last = at
        state[acc], want[seq] = (number, last), number
    data = [(a, None if s is None else START + timedelta(seconds=s), q) for a, s, q in rows]
    events = spark.createDataFrame(data, "acc_id string, event_ts timestamp, seq long")
    assert numbers(sessionize_arrival(events, hot_rows=hot_rows, span=span)) == want
