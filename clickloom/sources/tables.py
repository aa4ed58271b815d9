"""The engine's inputs derived from a folder of star-schema tables.

``events`` becomes canonical click events and ``part`` the catalog, by integer arithmetic
only, so the same rules can be written in any SQL dialect.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions import account_id, catalog_product_id, session_id
from clickloom.functions.times import ISO_PATTERN
from clickloom.operators.sessions import sessionize
from clickloom import schema as S
from clickloom.schema import EVENT_COLUMNS
from clickloom.sinks.topic import event_json
from clickloom.sources.topic import TOPIC

# The order in which the rules below number types and devices.
TYPE_ORDER = (
    S.VIEW, S.ADD_TO_CART, S.SEARCH, S.WISHLIST, S.CLICK, S.CHECKOUT, S.REMOVE_FROM_CART, S.PURCHASE
)
DEVICE_ORDER = ("Mobile", "Desktop", "Tablet")

# The columns used here; a given schema spares the job that would infer it.
EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, props string"
PART_SCHEMA = "p_partkey long, p_brand string, p_type string, p_size int"

REPLAY_OFFSET = 1_000_000_000
ARRIVAL_FACTOR = 1_103_515_245
ARRIVAL_PRIME = 2_147_483_647


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).parquet(f"{sf_dir}/part.parquet")


def _pick(values: tuple[str, ...], position) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def newest_event(spark: SparkSession, sf_dir: str) -> datetime | None:
    """Time of the newest event, as stored: a reproducible reference instant."""
    return _events(spark, sf_dir).agg(F.max("ts")).first()[0]


def unsessioned_events(
    spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Canonical events before sessions: ``session_id`` is null.

    ``since`` and ``until`` bound the stored time itself, so they reach the scan.
    """
    stored = _events(spark, sf_dir)
    if since is not None:
        stored = stored.where(F.col("ts") >= F.lit(since.isoformat(" ")).cast("timestamp_ntz"))
    if until is not None:
        stored = stored.where(F.col("ts") <= F.lit(until.isoformat(" ")).cast("timestamp_ntz"))
    raw = stored.select(
        "event_id",
        "user_id",
        "ts",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format("ts", ISO_PATTERN).alias("event_time"),
    )
    event_id, k, event_time = F.col("event_id"), F.col("k"), F.col("event_time")
    kind = (event_id * 31 + F.col("user_id") * 17 + k * 7) % 8
    account = account_id(F.col("user_id") + 1)
    product = catalog_product_id(k)
    return raw.select(
        F.when(event_id % 101 == 0, "").otherwise(account).alias("acc_id"),
        F.lit(None).cast("string").alias("session_id"),
        event_time,
        _pick(TYPE_ORDER, kind).alias("event_type"),
        F.when(event_id % 97 != 0, product).alias("product_id"),
        _pick(DEVICE_ORDER, event_id % 3).alias("device_type"),
        (1 + event_id % 60).cast("int").alias("time_on_page_minutes"),
        event_time.alias("created_at"),
        event_time.alias("updated_at"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        event_id.alias("seq"),
    )


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine event columns with sessions assigned, plus ``event_ts`` and ``seq``."""
    events = sessionize(unsessioned_events(spark, sf_dir))
    return events.select(*EVENT_COLUMNS, "event_ts", "seq")


def topic_records(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Events as they lie on the topic."""
    return events.select(
        F.col("acc_id").alias("key"),
        (event_json() if value is None else value).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def permuted(events: DataFrame) -> DataFrame:
    """The same events arriving in another order: ``seq`` runs through the residues of a prime
    above every id, so it stays unique and accounts step back in their sessions."""
    return events.withColumn("seq", F.col("seq") * ARRIVAL_FACTOR % ARRIVAL_PRIME)


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as texts in the shapes producers send, some of them no time at all."""
    shape = F.col("event_id") % 6
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(shape == 0, F.concat(plain, F.lit("Z")))
        .when(shape == 1, plain)
        .when(shape == 2, F.concat(plain, F.lit("+07:00")))
        .when(shape == 3, F.date_format("ts", "HH:mm:ss"))
        .when(shape == 4, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("not "), plain))
    )
    return _events(spark, sf_dir).select(F.col("event_id").alias("seq"), text.alias("event_time"))


def with_malformed(records: DataFrame) -> DataFrame:
    """Every 53rd record cannot be decoded."""
    broken = F.concat(F.lit("bad{"), F.col("offset").cast("string"))
    return records.withColumn(
        "value", F.when(F.col("offset") % 53 == 0, broken).otherwise(F.col("value"))
    )


def with_blank_sessions(events: DataFrame) -> DataFrame:
    """Four events of 13 have a session that is empty, blank, absent or without a number."""
    kind = F.col("seq") % 13
    session = (
        F.when(kind == 0, "").when(kind == 1, "  ").when(kind == 3, "abc")
        .when(kind != 2, F.col("session_id"))
    )
    return events.withColumn("session_id", session)


def moved_records(events: DataFrame) -> tuple[DataFrame, list[dict[int, int]]]:
    """Events as records of a topic that went from 3 partitions to 5, and where each layout began.

    An account's partition is its number modulo that of the partitions. The first three go on
    where they were, the new ones begin with offset 0, below what their accounts have had.
    """
    low, high = events.agg(F.min("seq"), F.max("seq")).first()
    middle = ((low or 0) + (high or 0)) // 2
    account = F.coalesce(F.substring("key", 4, 20).try_cast("bigint"), F.lit(0))
    event_id = F.col("offset")
    late = event_id > middle
    partition = F.when(late, account % 5).otherwise(account % 3).cast("int")
    records = topic_records(events).withColumns({
        "event_id": event_id,
        "partition": partition,
        "offset": F.when(late & (partition > 2), event_id - middle - 1).otherwise(event_id),
    })
    return records, [{0: 0, 1: 0, 2: 0}, {p: middle + 1 if p < 3 else 0 for p in range(5)}]


def odd_records(events: DataFrame) -> DataFrame:
    """Records as other producers write them: numbers for texts, in every form, and fractions of
    minutes; some that cannot be decoded, for each of the reasons."""
    seq = F.col("seq").cast("string")
    kind = F.col("seq") % 8

    def record(product: Column, session: str) -> Column:
        return F.concat(
            F.lit('{"acc_id": "'), "acc_id", F.lit('" , "product_id":'), product,
            F.lit(f',"session_id" :{session},"time_on_page_minutes":'), F.col("time_on_page_minutes").cast("string"),
            F.lit('.9,"device_type":"say \\"x\\": 1.50, 2.50"}'),
        )

    value = (
        F.when(kind == 0, record(F.concat(seq, F.lit(".50")), "1e3"))
        .when(kind == 1, record(F.concat(F.lit("-"), seq, F.lit(".0E+2")), '"12.50"'))
        .when(kind == 2, record(F.concat(F.lit('"00'), seq, F.lit('"')), "-0.0"))
        .when(kind == 3, record(F.concat(F.lit('{"k":'), seq, F.lit("}")), "null"))
        .when(kind == 4, record(F.concat(F.lit("00"), seq), "1"))
        .when(kind == 5, F.concat(F.lit("bad{"), seq))
        .when(kind == 6, record(seq, "true"))
    )
    return topic_records(events, value)


def replayed_events(events: DataFrame) -> DataFrame:
    """All events, and every tenth delivered again later with a changed value.

    One pass: each event unfolds into its one or two deliveries.
    """

    def delivery(seq: Column, minutes: Column) -> Column:
        return F.struct(seq.alias("seq"), minutes.alias("time_on_page_minutes"))

    seq, minutes = F.col("seq"), F.col("time_on_page_minutes")
    first, again = delivery(seq, minutes), delivery(seq + REPLAY_OFFSET, minutes + 1)
    deliveries = F.when(seq % 10 == 0, F.array(first, again)).otherwise(F.array(first))
    kept = [c for c in events.columns if c not in ("seq", "time_on_page_minutes")]
    return events.select(*kept, F.inline(deliveries)).select(*events.columns)


def session_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session ids in clean, absent and odd shapes, one per event."""
    event_id = F.col("event_id")
    shape = event_id % 6
    padded = session_id(event_id)
    text = (
        F.when(shape == 0, padded)
        .when(shape == 2, "")
        .when(shape == 3, "abc")
        .when(shape == 4, "SS99999999999")
        .when(shape == 5, "S1S2")
    )
    raw = _events(spark, sf_dir)
    return raw.select(event_id.alias("seq"), text.alias("session_id"))


def part_catalog(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    """Catalog from ``part``; ``fine`` categories are too small to fill a recommendation."""
    return _part(spark, sf_dir).select(
        catalog_product_id("p_partkey").alias("product_id"),
        _category(fine).alias("category_id"),
        F.col("p_brand").alias("brand_id"),
        F.col("p_partkey").alias("catalog_ord"),
    )


def _category(fine: bool):
    parts = [F.lit("CG-"), F.col("p_type"), F.lit("-"), F.col("p_size").cast("string")]
    if fine:
        parts += [F.lit("-"), (F.col("p_partkey") % 10).cast("string")]
    return F.concat(*parts)


def catalog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited catalog lines: clean, padded, over-long, comma-trailed and too short."""
    key = F.col("p_partkey")
    clean = F.concat_ws(
        ",",
        catalog_product_id(key),
        _category(False),
        F.col("p_brand"),
    )
    line = (
        F.when(key % 11 == 1, F.concat(F.lit("  "), F.replace(clean, F.lit(","), F.lit(" , "))))
        .when(key % 11 == 2, F.concat(clean, F.lit(",extra,columns")))
        .when(key % 11 == 3, F.concat(clean, F.lit(",,,")))
        .when(key % 11 == 4, F.lit("short,line,,"))
        .otherwise(clean)
    )
    parts = _part(spark, sf_dir)
    return parts.select(line.alias("line"), key.alias("catalog_ord"))
