from datetime import datetime

from clickloom.operators import dashboards


def frame(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t) if t else None, k, p, d) for t, k, p, d in rows],
        "event_ts timestamp, event_type string, product_id string, device_type string")


def test_velocity(spark):
    df = frame(spark, [("2024-01-01 00:00:59", "VIEW", "P", "M"),
                       ("2024-01-01 00:00:01", "VIEW", "P", "M"),
                       ("2024-01-01 00:03:00", "VIEW", "P", "M"), (None, "VIEW", "P", "M")])
    sparse = dashboards.ingestion_velocity(df).orderBy("minute").collect()
    assert [(r.minute.minute, r.events) for r in sparse] == [(0, 2), (3, 1)]
    filled = dashboards.ingestion_velocity_filled(df).orderBy("minute").collect()
    assert [(r.minute.minute, r.events) for r in filled] == [(0, 2), (1, 0), (2, 0), (3, 1)]


def test_funnel(spark):
    rows = [("2024-01-01", k, "P", "M") for k in ["VIEW"] * 3 + ["ADD_TO_CART"] + ["CLICK"]]
    got = dashboards.funnel(frame(spark, rows)).orderBy("stage_no").collect()
    assert [(r.stage, r.events, r.drop_off) for r in got] == [
        ("VIEW", 3, None), ("ADD_TO_CART", 1, 0.666667), ("CHECKOUT", 0, 1.0),
        ("PURCHASE", 0, None)]
    assert [r.events for r in dashboards.funnel(frame(spark, rows[:0])).collect()] == [0] * 4


def test_top_products(spark):
    names = ["B"] * 2 + ["A"] * 2 + ["C"] * 3 + [None] * 5
    df = frame(spark, [("2024-01-01", "VIEW", p, "M") for p in names])
    got = [(r.product_id, r.events) for r in dashboards.top_products(df, 2).collect()]
    assert got == [("C", 3), ("A", 2)]


def test_device_share(spark):
    devices = ["M", "M", "T", None]
    df = frame(spark, [("2024-01-01", "VIEW", "P", d) for d in devices])
    got = dashboards.device_share(df).orderBy("device_type").collect()
    assert [(r.device_type, r.events, r.share) for r in got] == [
        ("M", 2, 0.666667), ("T", 1, 0.333333)]


def test_recent(spark):
    df = frame(spark, [("2024-01-02 00:00:00", "VIEW", "P", "M"),
                       ("2024-01-01 00:00:00", "VIEW", "P", "M"),
                       ("2023-12-31 23:59:59", "VIEW", "P", "M")])
    newest = dashboards.newest_time(df)
    assert dashboards.recent_events(df, newest).count() == 2
    assert dashboards.recent_events(df, newest, hours=7 * 24).count() == 3


def test_velocity_over_a_given_range_and_across_days(spark):
    df = frame(spark, [("2024-01-01 23:58:10", "VIEW", "P", "M"), ("2024-01-03 00:01:00", "VIEW", "P", "M")])
    filled = dashboards.ingestion_velocity_filled(df).collect()
    assert len(filled) == 2 + 24 * 60 + 2 and sum(r.events for r in filled) == 2
    some = dashboards.ingestion_velocity_filled(
        df, datetime(2024, 1, 1, 23, 57, 30), datetime(2024, 1, 1, 23, 59)).orderBy("minute").collect()
    assert [(r.minute.minute, r.events) for r in some] == [(57, 0), (58, 1), (59, 0)]
    assert dashboards.ingestion_velocity_filled(df.limit(0)).count() == 0


def test_a_far_off_time_does_not_fail(spark):
    df = frame(spark, [("2024-01-01 00:00:00", "VIEW", "P", "M"), ("9999-12-31 00:00:00", "VIEW", "P", "M")])
    some = dashboards.ingestion_velocity_filled(df, end=datetime(2024, 1, 1, 0, 2)).orderBy("minute")
    assert [r.events for r in some.collect()] == [1, 0, 0]
    assert dashboards.ingestion_velocity_filled(df).limit(5).count() == 5
