from clickloom.sinks.documents import (
    append_documents,
    compact_documents,
    count_days,
    latest_by_id,
    newest_documents,
    read_day_counts,
    read_documents,
    typed_documents,
)
from clickloom.sinks.keyed import merge_counts, read_counts
from clickloom.sinks.topic import encode_events, keyed_records, stream_to_topic, write_topic

__all__ = [
    "append_documents",
    "compact_documents",
    "count_days",
    "encode_events",
    "keyed_records",
    "latest_by_id",
    "merge_counts",
    "newest_documents",
    "read_counts",
    "read_day_counts",
    "read_documents",
    "stream_to_topic",
    "typed_documents",
    "write_topic",
]
