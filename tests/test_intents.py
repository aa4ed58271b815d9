import random

import pytest

from clickloom import schema as S
from clickloom.operators import intents, pricing
from clickloom.operators.pricing import first_greater_after
from tests.model import EVENT_FIELDS, messy_events, session_number, track

NEVER = 10**9


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT_FIELDS)


def alerts(df):
    return sorted((tuple(r) for r in df.select(*S.ALERT_COLUMNS).collect()), key=repr)


def snapshot(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def steps(*rows):
    return [("ACC00000001", product, kind, f"SS{n:08d}", f"t{i}", i)
            for i, (kind, product, n) in enumerate(rows)]


def check(spark, rows, hot_rows=NEVER, span=NEVER):
    want_alerts, want_open = track(rows)
    df = frame(spark, rows)
    assert alerts(intents.pricing_alerts(df, hot_rows, span)) == want_alerts
    assert snapshot(intents.open_intents(df, hot_rows, span)) == want_open
    return want_alerts, want_open


CASES = {
    "capture": (steps(("ADD_TO_CART", "PR001", 1)), ["INTENT_CAPTURED"]),
    "two checkouts": (
        steps(("CHECKOUT", "P", 1), ("CHECKOUT", "P", 1)), ["CHECKOUT_FRICTION"]),
    "discount once": (
        steps(("ADD_TO_CART", "PR010", 1), ("VIEW", "PR020", 2), ("VIEW", "PR020", 3)),
        ["DYNAMIC_PRICING", "INTENT_CAPTURED"]),
    "purchase then remove": (
        steps(("ADD_TO_CART", "P", 1), ("PURCHASE", "P", 1), ("ADD_TO_CART", "P", 1),
              ("REMOVE_FROM_CART", "P", 1)),
        ["CART_REMOVED", "CONVERSION_SUCCESS", "INTENT_CAPTURED", "INTENT_CAPTURED"]),
    "discount and purchase on one event": (
        steps(("ADD_TO_CART", "P", 1), ("PURCHASE", "P", 2)),
        ["CONVERSION_SUCCESS", "DYNAMIC_PRICING", "INTENT_CAPTURED"]),
    "adding again resets": (
        steps(("ADD_TO_CART", "P", 1), ("VIEW", "Q", 2), ("ADD_TO_CART", "P", 2),
              ("VIEW", "Q", 3)),
        ["DYNAMIC_PRICING", "DYNAMIC_PRICING", "INTENT_CAPTURED", "INTENT_CAPTURED"]),
    "checkout can be the origin": (
        steps(("CHECKOUT", "P", 1), ("VIEW", "Q", 2)), ["DYNAMIC_PRICING"]),
    "purchase without intent": (steps(("PURCHASE", "P", 1)), []),
    "event without type": (
        steps(("ADD_TO_CART", "P", 1), (None, "Q", 2)), ["DYNAMIC_PRICING", "INTENT_CAPTURED"]),
    "blank account": ([("", "P", "CHECKOUT", "SS1", "t", 1), ("", "P", "CHECKOUT", "SS1", "t", 2)],
                      []),
}


def test_cases(spark):
    """All cases in one input, one account each."""
    rows = [
        (acc and f"{acc}-{case}", *rest)
        for case, (events, _) in CASES.items() for acc, *rest in events
    ]
    want, _ = check(spark, rows)
    for case, (_, kinds) in CASES.items():
        assert [a[0] for a in want if a[1].endswith(f"-{case}")] == kinds


def many(seeds, **shape):
    """Several messy inputs in one: accounts are told apart by the seed."""
    rows = []
    for seed in seeds:
        for acc, product, kind, session, time, seq in messy_events(seed, **shape):
            named = acc if acc is None or not acc.strip() else f"{seed}-{acc}"
            rows.append((named, product, kind, session, time, seq))
    return rows


@pytest.mark.parametrize("hot_rows, span", [(NEVER, NEVER), (20, 13), (0, 1), (30, 100)])
def test_messy_inputs_equal_the_model(spark, hot_rows, span):
    check(spark, many(range(60)), hot_rows, span)


@pytest.mark.parametrize("hot_rows, span", [(NEVER, NEVER), (20, 13)])
def test_summary_too_large_to_send(spark, monkeypatch, hot_rows, span):
    """Ended intents are shuffled to their sessions, other alerts come from where they are."""
    monkeypatch.setattr(intents, "SUMMARY_BYTES", -1)
    check(spark, many(range(200, 230)), hot_rows, span)


@pytest.mark.parametrize("block", [3])
def test_session_numbers_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(pricing, "BLOCK", block)
    check(spark, many(range(100, 140)))


def test_one_account_holds_most_rows(spark):
    rows = messy_events(7, size=1500, accounts=1, products=2)
    check(spark, rows, hot_rows=100, span=50)


def test_long_checkout_stretch_crosses_ranges(spark):
    rows = steps(("ADD_TO_CART", "P", 1), *[("CHECKOUT", "P", 1)] * 40, ("PURCHASE", "P", 2),
                 *[("CHECKOUT", "P", 2)] * 30, ("VIEW", "Q", 3))
    want, opened = check(spark, rows, hot_rows=5, span=4)
    assert opened[0][6] == 30


def test_single_kind_queries(spark):
    rows = many(range(10))
    want, _ = track(rows)
    df = frame(spark, rows)
    for kind, got in {
        S.INTENT_CAPTURED: intents.intents_captured(df),
        S.DYNAMIC_PRICING: intents.dynamic_pricing(df, 20, 13),
        S.CHECKOUT_FRICTION: intents.branch_alerts(df, S.CHECKOUT_FRICTION, 20, 13),
        S.CONVERSION_SUCCESS: intents.branch_alerts(df, S.CONVERSION_SUCCESS, 20, 13),
        S.CART_REMOVED: intents.branch_alerts(df, S.CART_REMOVED, 20, 13),
    }.items():
        assert alerts(got) == [a for a in want if a[0] == kind]


def test_checkout_attempts(spark):
    df = frame(spark, steps(("CHECKOUT", "P", 1), ("CHECKOUT", "P", 1), ("WISHLIST", "P", 1),
                            ("CHECKOUT", "P", 1)))
    got = [(r.seq, r.checkout_attempts, r.origin_action)
           for r in intents.checkout_attempts(df).orderBy("seq").collect()]
    assert got == [(0, 1, "CHECKOUT"), (1, 2, "CHECKOUT"), (3, 1, "WISHLIST")]


@pytest.mark.parametrize("span", [1, 5, 64, NEVER])
def test_search_equals_brute_force(spark, span):
    rng = random.Random(span)
    rows = [(f"A{rng.randint(0, 2)}", "P", "VIEW",
             f"SS{rng.choice([rng.randint(0, 9), rng.randint(0, 2**31 - 1)])}", "t", seq)
            for seq in range(150)]
    numbers = {(r[0], r[5]): session_number(r[3]) for r in rows}
    asked, want = [], set()
    for (acc, seq), number in numbers.items():
        end = rng.choice([None, seq + rng.randint(0, 40)])
        top = max(n for (a, _), n in numbers.items() if a == acc)
        asked.append((acc, "P", seq, end, number, top, f"s{seq}"))
        later = [s for (a, s), n in numbers.items()
                 if a == acc and s > seq and n > number and (end is None or s <= end)]
        if later:
            want.add((acc, f"s{seq}", min(later)))
    stale = spark.createDataFrame(
        asked, "acc_id string, product_id string, start_seq long, end_seq long, session_no int, "
        "top_no int, start_session_id string")
    got = first_greater_after(stale, frame(spark, rows), span).collect()
    assert {(r.acc_id, r.start_session_id, r.seq) for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("seed", [0, 1])
def test_many_texts_of_one_number(spark, seed):
    """Texts without digits are all session 0, and leading zeros make no other number."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(150)]
    texts += ["x1", "x01", "x001", "y1", "2", "02"]
    kinds = ["ADD_TO_CART", "VIEW", "CHECKOUT", "PURCHASE", "REMOVE_FROM_CART"]
    rows = [
        (rng.choice(["A", "A", "B"]), rng.choice("PQR"), rng.choice(kinds), rng.choice(texts), f"t{i}", i)
        for i in range(400)
    ]
    check(spark, rows)
    summary = pricing.session_summary(frame(spark, rows)).collect()
    want = {(r[0], session_number(r[3])) for r in rows}
    assert len(summary) == len(want) and {(r.acc_id, r.session_no) for r in summary} == want
    assert sum(r["rows"] for r in summary) == len(rows)
