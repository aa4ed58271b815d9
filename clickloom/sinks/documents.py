"""Typed documents in daily indices, upserted by a deterministic id.

The document table is an append-only parquet table partitioned by day and delivery. A delivery
is named by its writer and its batch, so writers that count their batches alike do not meet; the
same delivery again replaces its own partitions. A document that is delivered again is resolved
when the table is read, the highest ``seq`` winning. ``compact_documents`` folds the deliveries
of a table in place, while others may go on writing to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.functions import document_id, iso_parse, utc_day
from clickloom.plans import delete_folder
from clickloom.sinks.keyed import merge_counts, read_counts

# The envelope of a record, and its names in a document.
ENVELOPE = {
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
}
COMPACTED = "compacted"
DAYS = "days"
# Fixed value: the folder of rows without a partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def typed_documents(events: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Cast events to the document schema and route them to a daily index.

    ``ingest_ts`` stands in for an event time that does not parse. Envelope columns that the
    events still have are kept under their document names.
    """
    fallback = F.lit(None).cast("timestamp") if ingest_ts is None else ingest_ts
    parsed = iso_parse("event_time")
    event_ts = F.coalesce(parsed, fallback)
    return events.select(
        "acc_id",
        "session_id",
        "event_type",
        "product_id",
        "device_type",
        F.col("time_on_page_minutes").cast("float").alias("time_on_page_minutes"),
        parsed.alias("event_time"),
        iso_parse("created_at").alias("created_at"),
        iso_parse("updated_at").alias("updated_at"),
        event_ts.alias("event_ts"),
        parsed.isNull().alias("ts_parse_failed"),
        utc_day(event_ts).alias("index_date"),
        document_id().alias("doc_id"),
        "seq",
        *[F.col(c).alias(name) for c, name in ENVELOPE.items() if c in events.columns],
    )


def latest_by_id(documents: DataFrame) -> DataFrame:
    """Last delivered version of every document.

    The rank filter is also applied before the shuffle, so each map task sends one row
    per document id however often it was delivered.
    """
    newest = Window.partitionBy("index_date", "doc_id").orderBy(F.desc("seq"))
    return (
        documents.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def append_documents(
    documents: DataFrame, path: str, batch_id: int = 0, writer: str | None = None
) -> str:
    """Write one delivery and return its name.

    The same ``writer`` and ``batch_id`` again replace what they wrote before. Without a writer
    the delivery gets a name of its own and never replaces anything.
    """
    if writer is not None and writer.startswith(COMPACTED):
        raise ValueError(f"{COMPACTED} names compacted deliveries")
    return _append(documents, path, f"{writer or uuid.uuid4().hex}-{batch_id}")


def _append(documents: DataFrame, path: str, delivery: str) -> str:
    (
        latest_by_id(documents)
        .withColumn("delivery", F.lit(delivery))
        # Few files per day; a day too large for one task is split by AQE.
        .hint("rebalance", "index_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("index_date", "delivery")
        .parquet(path)
    )
    return delivery


def _stored(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    return stored.withColumns(
        {name: F.col(name).cast("string") for name in ("index_date", "delivery")}
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The table as the store shows it: one row per document id.

    A filter on ``index_date`` prunes the folders that are read.
    """
    return latest_by_id(_stored(spark, path)).drop("delivery")


def compact_documents(spark: SparkSession, path: str) -> int:
    """Fold the deliveries of every day that has several into one; the folders removed.

    The folded delivery is written under a new name before the ones it was made from are
    deleted. Readers between the two see documents twice and resolve them; deliveries that
    arrive meanwhile are not touched; a run that breaks off is completed by the next one.
    """
    parts = _stored(spark, path).select("index_date", "delivery").distinct()
    many = parts.groupBy("index_date").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # One row per folder of the table, which listing it has brought to the driver anyway.
    folders = parts.join(many.select("index_date"), "index_date").collect()
    if not folders:
        return 0
    names = sorted({row.delivery for row in folders})
    days = sorted({row.index_date for row in folders})
    rows = _stored(spark, path).where(F.col("index_date").isin(days) & F.col("delivery").isin(names))
    _append(rows.drop("delivery"), path, f"{COMPACTED}-{uuid.uuid4().hex}")
    for row in folders:
        delete_folder(spark, f"{path}/index_date={row.index_date}/delivery={row.delivery}")
    return len(folders)


def count_days(spark: SparkSession, path: str, delivery: str, counts: str, refresh: int) -> None:
    """Bring the number of documents per day up to date after a delivery, at the keyed table ``counts``.

    Only the days of the delivery change, and only their ids are read: a document that was there
    before, in another delivery or an earlier run of this one, counts once. Counting a day anew
    rather than adding to its count needs no order among deliveries, so replays are harmless.
    """
    stored = _stored(spark, path)
    # Partition values: they come from the listing, no file is opened for them.
    days = stored.where(F.col("delivery") == delivery).select("index_date").distinct()
    ids = stored.select("index_date", "doc_id").join(F.broadcast(days), "index_date", "left_semi").distinct()
    counted = ids.groupBy("index_date").agg(F.count(F.lit(1)).alias("events"))
    merge_counts(counted.select(F.lit(DAYS).alias("view"), F.col("index_date").alias("key"), "events"), counts, refresh)


def read_day_counts(spark: SparkSession, counts: str) -> DataFrame:
    """``daily_index_counts`` as far as the deliveries have been counted."""
    found = read_counts(spark, counts, DAYS)
    return found.select(F.col("key").alias("index_date"), F.col("events").alias("documents"))


def _days(spark: SparkSession, path: str) -> list[str]:
    """The index days of a table by the names of its folders, newest first; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    days = [name.split("=", 1)[1] for name in names if name.startswith("index_date=")]
    dated = [day for day in days if day != NO_DAY]
    return sorted(dated, key=lambda day: [int(part) for part in day.split(".")], reverse=True)


def newest_documents(spark: SparkSession, path: str, limit: int = 1) -> DataFrame:
    """``latest_documents`` of a table, from as few of its days as hold that many documents.

    Every document of a day is newer than all of an earlier day, so once the newest days have
    ``limit`` of them the others cannot contribute. Days are taken newest first, twice as many
    in each step; deliveries of one document count once, so a day of replays brings the next
    ones in. Documents without a day are last, and looked at when all days are.
    """
    days, taken, enough = _days(spark, path), 0, False
    stored = _stored(spark, path) if days else None
    while taken < len(days) and not enough:
        taken = min(len(days), max(1, 2 * taken))
        ids = stored.where(F.col("index_date").isin(days[:taken])).select("index_date", "doc_id")
        enough = ids.distinct().limit(limit).count() == limit
    if not enough:
        return read_documents(spark, path).orderBy(F.desc("event_ts"), "doc_id").limit(limit)
    newest = latest_by_id(stored.where(F.col("index_date").isin(days[:taken]))).drop("delivery")
    return newest.orderBy(F.desc("event_ts"), "doc_id").limit(limit)
