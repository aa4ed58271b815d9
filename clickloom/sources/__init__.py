from clickloom.sources.catalog import load_catalog, parse_catalog_lines
from clickloom.sources.decode import decode_events, decode_topic, quarantine_events
from clickloom.sources.topic import (
    read_topic,
    read_topic_files,
    stream_topic,
    stream_topic_files,
    topic_order,
)

__all__ = [
    "decode_events",
    "decode_topic",
    "load_catalog",
    "parse_catalog_lines",
    "quarantine_events",
    "read_topic",
    "read_topic_files",
    "stream_topic",
    "stream_topic_files",
    "topic_order",
]
