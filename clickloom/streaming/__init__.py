from clickloom.streaming.minutes import final_minutes
from clickloom.streaming.dashboards import (
    read_device_share,
    read_funnel,
    read_top_products,
    read_velocity,
    start_dashboards,
)
from clickloom.streaming.documents import first_deliveries, start_documents
from clickloom.streaming.intents import open_intents_at, stream_alerts
from clickloom.streaming.pipeline import start_pipeline
from clickloom.streaming.queries import start_table, use_rocksdb_state
from clickloom.streaming.sessions import sessions_reached, stream_sessions

__all__ = [
    "final_minutes",
    "first_deliveries",
    "read_device_share",
    "read_funnel",
    "read_top_products",
    "read_velocity",
    "start_dashboards",
    "open_intents_at",
    "sessions_reached",
    "start_documents",
    "start_pipeline",
    "start_table",
    "stream_alerts",
    "stream_sessions",
    "use_rocksdb_state",
]
