"""Event topic scans, and the same columns read from files.

Three independent readers of the topic exist: pricing and the document sink start at the
earliest offset, recommendations at the latest. Each runs as its own query with its own
checkpoint, which takes the place of a consumer group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the event topic.
TOPIC = "customer-events-raw"
MAX_OFFSETS_PER_TRIGGER = 5_000_000
TOPIC_FILE_SCHEMA = (
    "key string, value string, topic string, partition int, offset long, timestamp timestamp"
)


def _text_payload(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def _options(servers: str, topic: str, starting: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def read_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "earliest"
) -> DataFrame:
    reader = spark.read.format("kafka").options(**_options(servers, topic, starting))
    return _text_payload(reader.load())


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """The limit bounds what one micro-batch, and so one account in it, can hold."""
    reader = spark.readStream.format("kafka").options(**_options(servers, topic, starting))
    reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return _text_payload(reader.load())


def read_topic_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A topic kept as files with the envelope columns."""
    return spark.read.schema(TOPIC_FILE_SCHEMA).format(fmt).load(path)


def stream_topic_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(TOPIC_FILE_SCHEMA).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


# Offsets below 2**48 and layouts below 2**15 make one number.
LAYOUT_BITS = 48


def topic_order(records: DataFrame, layouts: list[dict[int, int]] | None = None) -> DataFrame:
    """Add ``seq``, which orders the records of every account as they were written.

    A key has one partition as long as the topic has the same partitions, and offsets order it
    there. When their number changes, keys move, and offsets of different partitions do not
    compare. ``layouts`` says where each layout began: for the first, second, ... layout the first
    offset of each of its partitions. A record belongs to the last layout that began in its partition
    at its offset or before, and ``seq`` is the number of the layout, then the offset: unique per
    account, as an account has one partition per layout. Without ``layouts`` it is the offset.
    """
    if not layouts:
        return records.withColumn("seq", F.col("offset"))
    begins: dict[int, list[tuple[int, int]]] = {}
    for number, partitions in enumerate(layouts):
        for partition, offset in partitions.items():
            begins.setdefault(partition, []).append((number, offset))
    # As many rows as the topic has had partitions and layouts; joined, not matched one by one.
    rows = [(partition, [{"layout": n, "first": o} for n, o in own]) for partition, own in sorted(begins.items())]
    spark = records.sparkSession
    known = spark.createDataFrame(rows, "partition int, _begins array<struct<layout: bigint, first: bigint>>")
    joined = records.join(F.broadcast(known), "partition", "left")
    begun = F.filter("_begins", lambda b: b["first"] <= F.col("offset"))
    layout = F.array_max(F.transform(begun, lambda b: b["layout"]))
    known_layout = F.when(layout.isNotNull(), layout).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("no layout has partition"), F.col("partition")))
    )
    seq = F.shiftleft(known_layout.cast("bigint"), LAYOUT_BITS) + F.col("offset")
    return joined.withColumn("seq", seq).select(*records.columns, "seq")
