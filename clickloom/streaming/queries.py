"""Starting queries: one checkpoint each, so every job keeps its own position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed state in RocksDB with changelog checkpoints: it may exceed memory, and a
    commit uploads what changed rather than the whole store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every ``interval``, or once over all that is available when it is None."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def start_table(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append a stream of alerts, recommendations or rejects to a parquet table, exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()
