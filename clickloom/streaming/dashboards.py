"""Dashboards that stand: counts kept up to date by one streaming aggregation.

An event counts in several views (its minute, its stage of the funnel, its product, its device), so
it is unfolded into one row per view and counted by (view, key) with map-side combine: one scan of
the topic and one state for all of them. Each micro-batch puts out the groups that changed, and they
are merged into a keyed table that the dashboards read; no refresh reads events again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import dashboards
from clickloom.schema import FUNNEL_STAGES
from clickloom.sinks.keyed import FOLD, merge_counts, read_counts
from clickloom.streaming.queries import triggered

VELOCITY, FUNNEL, PRODUCTS, DEVICES = "velocity", "funnel", "products", "devices"


def view_counts(events: DataFrame) -> DataFrame:
    """Rows ``view, key, events``: for a stream in update mode, or for a table."""
    minute = F.floor(F.unix_micros("event_ts") / F.lit(60_000_000)).cast("string")
    stage = F.when(F.col("event_type").isin(*FUNNEL_STAGES), F.col("event_type"))
    keys = {VELOCITY: minute, FUNNEL: stage, PRODUCTS: F.col("product_id"), DEVICES: F.col("device_type")}
    rows = [F.struct(F.lit(view).alias("view"), key.alias("key")) for view, key in keys.items()]
    unfolded = events.select(F.inline(F.array(*rows))).where("key is not null")
    return unfolded.groupBy("view", "key").agg(F.count(F.lit(1)).alias("events"))


def start_dashboards(
    events: DataFrame, path: str, checkpoint: str, interval: str | None = None, fold: int = FOLD
) -> StreamingQuery:
    """Keep the counts of all views at ``path``; a micro-batch that runs again replaces itself."""
    writer = (
        view_counts(events).writeStream.outputMode("update")
        .foreachBatch(lambda changed, batch_id: merge_counts(changed, path, batch_id, fold))
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, interval).start()


def read_velocity(spark: SparkSession, path: str) -> DataFrame:
    """``ingestion_velocity`` as far as the stream has come."""
    minute = F.timestamp_seconds(F.col("key").cast("long") * 60)
    return read_counts(spark, path, VELOCITY).select(minute.alias("minute"), "events")


def read_funnel(spark: SparkSession, path: str) -> DataFrame:
    counts = read_counts(spark, path, FUNNEL)
    return dashboards.funnel_of(counts.agg(*[
        F.coalesce(F.sum(F.when(F.col("key") == s, F.col("events"))), F.lit(0)).alias(s) for s in FUNNEL_STAGES
    ]))


def read_top_products(spark: SparkSession, path: str, limit: int = 10) -> DataFrame:
    return dashboards.top_of(read_counts(spark, path, PRODUCTS).withColumnRenamed("key", "product_id"), limit)


def read_device_share(spark: SparkSession, path: str) -> DataFrame:
    return dashboards.share_of(read_counts(spark, path, DEVICES).withColumnRenamed("key", "device_type"))
