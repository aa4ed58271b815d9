import json
from datetime import datetime

import pytest

from clickloom.schema import EVENT_COLUMNS, EVENT_SCHEMA
from clickloom.sinks import encode_events, keyed_records
from clickloom.sources import (
    decode_events,
    decode_topic,
    load_catalog,
    parse_catalog_lines,
    quarantine_events,
    tables,
    topic_order,
)

SAMPLE = ("ACC00000088", "SS00000001", "2026-07-28T23:30:00.123456+07:00", "VIEW", "PR630",
          "Mobile", 33, "2026-07-28T23:30:00.123456+07:00", "2026-07-28T23:30:00.123456+07:00")


def test_round_trip(spark):
    events = spark.createDataFrame([SAMPLE, (None,) * 9], EVENT_SCHEMA)
    encoded = encode_events(events).select("value")
    texts = [r.value for r in encoded.collect()]
    assert all(tuple(json.loads(t)) == EVENT_COLUMNS for t in texts)
    back = decode_events(encoded).select(*EVENT_COLUMNS).collect()
    assert [tuple(r) for r in back] == [SAMPLE, (None,) * 9]


def test_key_is_the_account(spark):
    events = spark.createDataFrame([SAMPLE], EVENT_SCHEMA)
    assert keyed_records(events).first().key == "ACC00000088"


ACCEPTED = [
    ('{"time_on_page_minutes":33}', 33),
    ('{"time_on_page_minutes":"33"}', 33),
    ('{"time_on_page_minutes":" 33 "}', 33),
    ('{"time_on_page_minutes":33.7}', 33),
    ('{"time_on_page_minutes":-33.7}', -33),
    ('{"time_on_page_minutes":1e2}', 100),
    ('{"time_on_page_minutes":""}', None),
    ('{"time_on_page_minutes":null}', None),
    ('{"unknown":{"a":[1]}}', None),
    ("{}", None),
]


NUMBERS = [
    ('{"product_id":12.50}', "12.50"),
    ('{"product_id" : 1e3 }', "1e3"),
    ('{"time_on_page_minutes":5,"product_id":-0.0}', "-0.0"),
    ('{"product_id":1E+2,"acc_id":"a\\"b\\": 1.50, 2.50","session_id":0.10}', "1E+2"),
    ('{"product_id":12345678901234567890.10}', "12345678901234567890.10"),
    ('{"product_id":"007"}', "007"),
    ('{"product_id":"x\\\\","session_id":1.0}', "x\\"),
    ('{"product_id":true,"acc_id":7.70}', "true"),
    ('{"acc_id":7.70}', None),
]


def test_numbers_keep_their_form(spark):
    records = spark.createDataFrame([(value,) for value, _ in NUMBERS], "value string")
    got = {r.value: r.product_id for r in decode_events(records).collect()}
    assert got == dict(NUMBERS)
    others = {r.value: (r.acc_id, r.session_id) for r in decode_events(records).collect()}
    assert others[NUMBERS[3][0]] == ('a"b": 1.50, 2.50', "0.10") and others[NUMBERS[6][0]][1] == "1.0"


def test_long_records(spark):
    """Many numbers, long texts; a number that is not one is no number in quotes either."""
    long = "x 1.50 " * 20_000
    rows = [('{"product_id":1.50,"more":[' + "1.0," * 20_000 + '2.0],"acc_id":"' + long + '"}',),
            ('{"product_id":007}',), ('{"product_id":1.}',), ('{"product_id":+1}',)]
    records = spark.createDataFrame(rows, "value string")
    (good,) = decode_events(records).collect()
    assert good.product_id == "1.50" and good.acc_id == long
    assert [r.reject_reason for r in quarantine_events(records).collect()] == ["malformed_json"] * 3


def test_order_across_layouts(spark):
    """Partitions that were added later begin with small offsets; an old one goes on."""
    layouts = [{0: 0, 1: 0}, {0: 50, 1: 40, 2: 0}, {0: 60, 1: 70, 2: 30, 3: 0}]
    log = [(1, 39), (1, 40), (2, 29), (2, 30), (3, 0), (0, 49), (0, 59), (0, 60)]
    rows = spark.createDataFrame([(p, o, "x") for p, o in log], "partition int, offset long, seqs string")
    got = topic_order(rows, layouts)
    assert got.columns == [*rows.columns, "seq"]
    layout = {(r.partition, r.offset): (r.seq >> 48, r.seq & (2**48 - 1)) for r in got.collect()}
    assert layout == {(1, 39): (0, 39), (1, 40): (1, 40), (2, 29): (1, 29), (2, 30): (2, 30), (3, 0): (2, 0),
                      (0, 49): (0, 49), (0, 59): (1, 59), (0, 60): (2, 60)}
    assert [r.seq for r in topic_order(rows).collect()] == [o for _, o in log]
    with pytest.raises(Exception, match="no layout has partition"):
        topic_order(spark.createDataFrame([(9, 1)], "partition int, offset long"), layouts).collect()


def test_accepted(spark):
    records = spark.createDataFrame([(value,) for value, _ in ACCEPTED], "value string")
    got = {r.value: r.time_on_page_minutes for r in decode_events(records).collect()}
    assert got == dict(ACCEPTED)


QUARANTINED = [
    (None, "null_value"),
    ("", "malformed_json"),
    ("  ", "malformed_json"),
    ("null", "malformed_json"),
    ("bad{5", "malformed_json"),
    ("123", "malformed_json"),
    ('[{"acc_id":"A"}]', "malformed_json"),
    ('{"acc_id":"A"', "malformed_json"),
    ("{'acc_id':'A'}", "malformed_json"),
    ('{"time_on_page_minutes":NaN}', "malformed_json"),
    ('{"time_on_page_minutes":"33.7"}', "wrong_type"),
    ('{"time_on_page_minutes":"x"}', "wrong_type"),
    ('{"time_on_page_minutes":true}', "wrong_type"),
    ('{"time_on_page_minutes":3000000000}', "wrong_type"),
    ('{"time_on_page_minutes":{"a":1}}', "wrong_type"),
    ('{"acc_id":{"a":1}}', "wrong_type"),
    ('{"product_id":["a"]}', "wrong_type"),
]


def test_quarantined(spark):
    records = spark.createDataFrame([(value,) for value, _ in QUARANTINED], "value string")
    assert {r.value: r.reject_reason for r in quarantine_events(records).collect()} == dict(
        QUARANTINED)
    assert decode_events(records).count() == 0


def test_text_that_looks_nested_is_kept(spark):
    records = spark.createDataFrame([('{"acc_id":"{x}","product_id":"[1]"}',)], "value string")
    row = decode_events(records).first()
    assert (row.acc_id, row.product_id) == ("{x}", "[1]")


def test_json_is_parsed_once(spark):
    records = spark.createDataFrame([("{}",)], "value string").repartition(2)
    plan = decode_topic(records).where("reject_reason IS NULL")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json") == 1


def test_catalog_lines(spark):
    lines = ["P1,C1,B1", " P2 , C2 ,\tB2", "P3,C3,B3,x,y", "P4,C4,B4,,", "P5,C5,,", "P6,C6", "",
             ",,B7", " , , ", "P1,C9,B9"]
    df = spark.createDataFrame(list(zip(lines, range(len(lines)))), "line string, catalog_ord long")
    rows = sorted((r.catalog_ord, r.product_id, r.category_id, r.brand_id)
                  for r in parse_catalog_lines(df).collect())
    assert rows == [(0, "P1", "C1", "B1"), (1, "P2", "C2", "B2"), (2, "P3", "C3", "B3"),
                    (3, "P4", "C4", "B4"), (7, "", "", "B7"), (8, "", "", ""),
                    (9, "P1", "C9", "B9")]


def test_catalog_file(spark, tmp_path):
    path = tmp_path / "products.csv"
    body = [f'PR{i:03d},CG{i % 7},"BR{i % 5}' for i in range(2000)]
    path.write_text("\n".join(["product_id,category_id,brand_id", *body]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = load_catalog(spark, str(path)).orderBy("catalog_ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.product_id for r in rows] == [f"PR{i:03d}" for i in range(2000)]
    assert rows[3].brand_id == '"BR3'


def test_absent_catalog_is_empty(spark, tmp_path):
    assert load_catalog(spark, str(tmp_path / "none.csv")).count() == 0


def test_large_numbers_are_not_cut(spark, tmp_path):
    time = datetime(2024, 1, 1)
    rows = [(1, time, 99_999_999, '{"k": 1234}'), (2, time, 9_999_999, '{"k": 5}')]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, props string")
    frame.write.parquet(str(tmp_path / "events.parquet"))
    got = {r.seq: (r.acc_id, r.product_id) for r in tables.unsessioned_events(spark, str(tmp_path)).collect()}
    assert got == {1: ("ACC100000000", "PR1234"), 2: ("ACC10000000", "PR005")}


def test_time_bounds_reach_the_scan(spark, sf_dir):
    newest = tables.newest_event(spark, sf_dir)
    events = tables.unsessioned_events(spark, sf_dir, newest, newest)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and events.count() >= 1


def test_replays_unfold_in_one_pass(spark, sf_dir):
    events = tables.unsessioned_events(spark, sf_dir)
    twice = tables.replayed_events(events)
    assert twice.columns == events.columns
    assert twice.count() == events.count() + events.where("seq % 10 = 0").count()
    assert twice._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
