"""The topic's standing jobs, each reading it on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions import iso_parse
from clickloom.operators.recommend import join_recommendations, prepare_recommendations
from clickloom.sinks import typed_documents
from clickloom.sources import decode_events, quarantine_events, topic_order
from clickloom.streaming.dashboards import start_dashboards
from clickloom.streaming.documents import start_documents
from clickloom.streaming.intents import stream_alerts
from clickloom.streaming.queries import start_table, use_rocksdb_state

# Batches after which the folders of the document table are folded.
COMPACT_EVERY = 100


def start_pipeline(
    spark: SparkSession,
    open_topic: Callable[[str], DataFrame],
    catalog: DataFrame,
    root: str,
    interval: str | None = None,
    layouts: list[dict[int, int]] | None = None,
) -> dict[str, StreamingQuery]:
    """Start alerts, documents, rejects, dashboards (from the earliest offset) and recommendations
    (from the latest).

    The document table is compacted as it grows, and its daily counts are kept at ``days``; the
    counts behind the dashboards at ``dashboards``.

    ``open_topic(starting)`` gives a stream of topic records, for instance
    ``lambda starting: stream_topic(spark, servers, starting=starting)``. Tables lie under
    ``root``; each query has its own checkpoint there and can be stopped and started alone.
    ``layouts`` is what ``topic_order`` needs where the topic's partitions have changed.
    """
    use_rocksdb_state(spark)

    def events(starting: str) -> DataFrame:
        return decode_events(topic_order(open_topic(starting), layouts))

    def table(name: str, rows: DataFrame) -> StreamingQuery:
        return start_table(rows, f"{root}/{name}", f"{root}/_checkpoints/{name}", interval)

    documents = typed_documents(events("earliest"), F.col("timestamp"))
    # A time that does not parse counts as the time of its record, as in the documents.
    event_ts = F.coalesce(iso_parse("event_time"), F.col("timestamp"))
    counted = events("earliest").withColumn("event_ts", event_ts)
    lists = prepare_recommendations(catalog)
    return {
        "alerts": table("alerts", stream_alerts(events("earliest"))),
        "rejects": table("rejects", quarantine_events(open_topic("earliest"))),
        "recommendations": table(
            "recommendations", join_recommendations(events("latest"), lists)
        ),
        "documents": start_documents(
            documents, f"{root}/documents", f"{root}/_checkpoints/documents", interval,
            compact_every=COMPACT_EVERY, counts=f"{root}/days",
        ),
        "dashboards": start_dashboards(
            counted, f"{root}/dashboards", f"{root}/_checkpoints/dashboards", interval
        ),
    }
