"""Events to JSON records keyed by account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from clickloom.functions import routing_key
from clickloom.schema import EVENT_COLUMNS
from clickloom.sources.topic import TOPIC

# Delivery settings of the event topic.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "20",
}


def event_json() -> Column:
    """The nine columns in canonical order, nulls written out."""
    return F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame) -> DataFrame:
    return events.withColumn("value", event_json())


def keyed_records(events: DataFrame) -> DataFrame:
    return events.select(routing_key().alias("key"), event_json().alias("value"))


def write_topic(events: DataFrame, servers: str, topic: str = TOPIC) -> None:
    (
        keyed_records(events)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_to_topic(
    events: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC
) -> DataStreamWriter:
    return (
        keyed_records(events)
        .writeStream.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
