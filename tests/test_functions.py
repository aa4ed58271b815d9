from pyspark.sql import functions as F

from clickloom import functions as fn, schema as S


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_session_number(spark):
    values = ["SS00000001", "SS00000004", "SS00000123", None, "", "abc", "SS99999999999",
              "S1S2", "SS2147483647", "SS2147483648", " "]
    assert column(spark, values, fn.parse_session_number("x")) == [
        1, 4, 123, 0, 0, 0, 0, 12, 2147483647, 0, 0]


def test_blank_follows_java(spark):
    values = [None, "", " ", "\t\n", " ", " ", "\u001c", "a", " a "]
    assert column(spark, values, fn.is_blank("x")) == [
        True, True, True, True, True, False, True, False, False]


def test_trim_follows_java(spark):
    assert column(spark, [" a b ", "\ta\x00", " a"], fn.java_trim("x")) == [
        "a b", "a", " a"]


def test_id_formats(spark):
    row = spark.range(1).select(
        fn.session_id(F.lit(4)), fn.account_id(F.lit(88)), fn.catalog_product_id(F.lit(7)),
        fn.catalog_product_id(F.lit(1234)), fn.session_id(F.lit(123456789))
    ).first()
    assert tuple(row) == ("SS00000004", "ACC00000088", "PR007", "PR1234", "SS123456789")


def test_document_id_keeps_placeholders(spark):
    df = spark.createDataFrame(
        [("A", "S", "t"), (None, "S", "t"), ("A", None, None)],
        "acc_id string, session_id string, event_time string",
    )
    assert [r[0] for r in df.select(fn.document_id()).collect()] == [
        "A_S_t", "%{acc_id}_S_t", "A_%{session_id}_%{event_time}"]


def test_iso_times(spark):
    values = ["2024-02-09T00:09:00.000+00:00", "2026-07-28T23:30:00.1234567+07:00", "later", None]
    shown = F.date_format(fn.iso_parse("x"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert column(spark, values, shown) == [
        "2024-02-09 00:09:00.000000", "2026-07-28 16:30:00.123456", None, None]
    assert column(spark, values, fn.iso_format(fn.iso_parse("x")))[0] == (
        "2024-02-09T00:09:00.000000Z")


def test_utc_day_ignores_session_zone(spark):
    values = ["2024-01-01T00:30:00+00:00", "2024-01-01T23:30:00+00:00", "1969-12-31T23:59:59Z"]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        days = column(spark, values, fn.utc_day(fn.iso_parse("x")))
        texts = column(spark, values, fn.iso_format(fn.iso_parse("x")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert texts == ["2024-01-01T00:30:00.000000Z", "2024-01-01T23:30:00.000000Z",
                     "1969-12-31T23:59:59.000000Z"]
    assert days == ["2024.01.01", "2024.01.01", "1969.12.31"]


def test_vocabulary():
    assert (S.VIEW, S.ADD_TO_CART, S.SEARCH, S.WISHLIST, S.CLICK, S.CHECKOUT,
            S.REMOVE_FROM_CART, S.PURCHASE) == (
        "VIEW", "ADD_TO_CART", "SEARCH", "WISHLIST", "CLICK", "CHECKOUT", "REMOVE_FROM_CART",
        "PURCHASE")


def test_iso_parse_needs_a_date_and_no_zone(spark):
    texts = {
        "2024-01-01T10:00:00Z": 1704103200, "2024-01-01T10:00:00": 1704103200,
        "2024-01-01 10:00:00": 1704103200, "2024-01-01T10:00:00+07:00": 1704078000,
        "2024-01-01": 1704067200, "10:00:00": None, "T10:00:00": None, "now": None, "": None,
        "2024-13-01": None, None: None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = frame.select("t", F.unix_seconds(fn.iso_parse("t")).alias("s")).collect()
            assert {r.t: r.s for r in got} == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
