"""Registered queries that run streams over the given tables, and ask them what batch jobs answer too."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import intents
from clickloom.plans import stage, staging_root
from clickloom.sinks import append_documents, compact_documents, count_days, newest_documents, read_day_counts, typed_documents
from clickloom.sources import decode_events, tables, topic_order
from clickloom.streaming import (
    open_intents_at,
    read_device_share,
    read_funnel,
    read_top_products,
    read_velocity,
    start_dashboards,
    start_table,
    stream_alerts,
    use_rocksdb_state,
)


def _folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/live-{uuid.uuid4().hex}"


def _middle(rows: DataFrame) -> int:
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    return 0 if low is None else (low + high) // 2


def _in_two_runs(rows: DataFrame, folder: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """The rows arrive in two halves by ``seq``; the query ends after the first and is started again."""
    spark, rows = rows.sparkSession, stage(rows)
    middle = _middle(rows)
    for part in (F.col("seq") <= middle, F.col("seq") > middle):
        rows.where(part).write.mode("append").parquet(f"{folder}/in")
        start(spark.readStream.schema(rows.schema).parquet(f"{folder}/in")).awaitTermination()


def live_intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open intents, read from the state of the alert stream."""
    use_rocksdb_state(spark)
    folder = _folder(spark)
    events = tables.canonical_events(spark, sf_dir).select(*intents.INPUT_COLUMNS)
    _in_two_runs(
        events, folder, lambda s: start_table(stream_alerts(s), f"{folder}/alerts", f"{folder}/checkpoint")
    )
    return open_intents_at(spark, f"{folder}/checkpoint")


def handed_over_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alerts: of the first half by a batch job, of the second by a stream that takes over
    the intents the first has left open."""
    use_rocksdb_state(spark)
    folder = _folder(spark)
    events = stage(tables.canonical_events(spark, sf_dir).select(*intents.INPUT_COLUMNS))
    middle = _middle(events)
    first = events.where(F.col("seq") <= middle)
    events.where(F.col("seq") > middle).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    opened = stage(intents.open_intents(first))
    start_table(
        stream_alerts(stream, opened), f"{folder}/alerts", f"{folder}/checkpoint"
    ).awaitTermination()
    return intents.pricing_alerts(first).unionByName(spark.read.parquet(f"{folder}/alerts"))


def _standing(read: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A dashboard read from the counts that a stream keeps."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_rocksdb_state(spark)
        folder = _folder(spark)
        events = tables.unsessioned_events(spark, sf_dir)
        _in_two_runs(
            events, folder, lambda s: start_dashboards(s, f"{folder}/counts", f"{folder}/checkpoint")
        )
        return read(spark, f"{folder}/counts")

    return query


def day_counts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per day, brought up to date after every delivery; one of them arrives twice, and
    the table is compacted in between."""
    folder = _folder(spark)
    documents, counts = f"{folder}/documents", f"{folder}/days"
    rows = stage(typed_documents(tables.replayed_events(tables.canonical_events(spark, sf_dir))))
    first = F.col("seq") < tables.REPLAY_OFFSET
    even = rows.where(first & (F.col("seq") % 2 == 0))
    odd = rows.where(first & (F.col("seq") % 2 == 1))
    deliveries = ((even, 0), (odd, 1), (even, 0), (rows.where(~first), 2))
    for refresh, (delivery, batch) in enumerate(deliveries):
        count_days(spark, documents, append_documents(delivery, documents, batch, "w"), counts, refresh)
        if refresh == 1:
            compact_documents(spark, documents)
    return read_day_counts(spark, counts)


def newest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest documents of a table; its newest days are found to hold enough."""
    documents = f"{_folder(spark)}/documents"
    rows = typed_documents(tables.replayed_events(tables.canonical_events(spark, sf_dir)))
    rows = stage(rows)
    for part in (0, 1):
        append_documents(rows.where(F.col("seq") % 2 == part), documents, part, "w")
    return newest_documents(spark, documents, 20).select("index_date", "doc_id", "event_type", "seq")


def alerts_across_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of a topic whose number of partitions has changed, so that accounts have moved."""
    events = tables.canonical_events(spark, sf_dir)
    records, layouts = tables.moved_records(events)
    numbered = stage(decode_events(topic_order(records, layouts)).select(
        "acc_id", "product_id", "event_type", "session_id", "event_time", "seq", "event_id"
    ))
    alerts = intents.pricing_alerts(numbered.select(*intents.INPUT_COLUMNS))
    names = numbered.select("acc_id", "seq", "event_id")
    return alerts.join(names, ["acc_id", "seq"]).withColumn("seq", F.col("event_id")).drop("event_id")


QUERIES = {
    "live_intents": live_intents,
    "handed_over_alerts": handed_over_alerts,
    "live_velocity": _standing(read_velocity),
    "live_funnel": _standing(read_funnel),
    "live_top_products": _standing(read_top_products),
    "live_device_share": _standing(read_device_share),
    "day_counts_kept": day_counts_kept,
    "newest_stored": newest_stored,
    "alerts_across_layouts": alerts_across_layouts,
}
