"""Dashboard questions over events: one partial aggregation each, ordering only afterwards."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.schema import FUNNEL_STAGES


def recent_events(events: DataFrame, reference: Column, hours: int = 24) -> DataFrame:
    """Events of the last ``hours`` before ``reference``."""
    since = reference - F.make_dt_interval(hours=F.lit(hours))
    return events.where((F.col("event_ts") >= since) & (F.col("event_ts") <= reference))


def newest_time(events: DataFrame) -> Column:
    """Newest event time as a scalar subquery: a reproducible reference instant."""
    return events.agg(F.max("event_ts")).scalar()


def ingestion_velocity(events: DataFrame) -> DataFrame:
    """Events per one-minute bucket."""
    bucket = F.window("event_ts", "1 minute")["start"].alias("minute")
    return events.where(F.col("event_ts").isNotNull()).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("events")
    )


def ingestion_velocity_filled(
    events: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The same with empty minutes, from the first to the last bucket or from ``start`` to
    ``end`` (both included).

    The range is cut into days, every day unfolds into its minutes in its own task, and the
    counts meet them in an equi-join; no task holds more than a day at a time.
    """
    minute = F.make_dt_interval(mins=F.lit(1))
    counts = ingestion_velocity(events)

    def bound(given: datetime | None, found: Column) -> Column:
        return found if given is None else F.date_trunc("minute", F.lit(given))

    ends = counts.agg(F.min("minute").alias("_low"), F.max("minute").alias("_high")).select(
        bound(start, F.col("_low")).alias("low"), bound(end, F.col("_high")).alias("high")
    )
    first, last = F.unix_date(F.to_date("low")), F.unix_date(F.to_date("high"))
    days = ends.where("low <= high").select(
        "low", "high", F.explode(F.sequence(first, last)).alias("day")
    )
    day = F.date_from_unix_date("day").cast("timestamp")
    until = F.least("high", day + F.make_dt_interval(mins=F.lit(24 * 60 - 1)))
    spine = days.repartition("day").select(
        F.explode(F.sequence(F.greatest("low", day), until, minute)).alias("minute")
    )
    return spine.join(counts, "minute", "left").select(
        "minute", F.coalesce("events", F.lit(0)).alias("events")
    )


def funnel(events: DataFrame) -> DataFrame:
    """Counts of the conversion stages, in order, with the drop-off from stage to stage."""
    counted = events.where(F.col("event_type").isin(*FUNNEL_STAGES)).agg(
        *[F.count(F.when(F.col("event_type") == s, 1)).alias(s) for s in FUNNEL_STAGES]
    )
    return funnel_of(counted)


def funnel_of(counted: DataFrame) -> DataFrame:
    """The funnel from one row with the count of every stage."""
    rows = []
    previous = None
    for position, stage in enumerate(FUNNEL_STAGES, start=1):
        drop = F.lit(None).cast("double")
        if previous is not None:
            ratio = F.col(stage) / F.nullif(F.col(previous), F.lit(0))
            drop = F.round(1 - ratio, 6)
        rows.append(
            F.struct(
                F.lit(position).alias("stage_no"),
                F.lit(stage).alias("stage"),
                F.col(stage).alias("events"),
                drop.alias("drop_off"),
            )
        )
        previous = stage
    return counted.select(F.inline(F.array(*rows)))


def top_products(events: DataFrame, limit: int = 10) -> DataFrame:
    """Products with the most events; ties by product id."""
    counts = events.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("events")
    )
    return top_of(counts, limit)


def top_of(counts: DataFrame, limit: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("events"), "product_id").limit(limit)


def device_share(events: DataFrame) -> DataFrame:
    """Events per device type and their share of all events with a device."""
    counts = events.where(F.col("device_type").isNotNull()).groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events")
    )
    return share_of(counts)


def share_of(counts: DataFrame) -> DataFrame:
    """Few rows, one per device type, so one window over all of them."""
    total = F.sum("events").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("events") / total, 6))


def daily_index_counts(documents: DataFrame) -> DataFrame:
    """Documents per daily index: deliveries of one document count once."""
    ids = documents.select("index_date", "doc_id").distinct()
    return ids.groupBy("index_date").agg(F.count(F.lit(1)).alias("documents"))


def latest_documents(documents: DataFrame, limit: int = 1) -> DataFrame:
    """The newest documents."""
    return documents.orderBy(F.desc("event_ts"), "doc_id").limit(limit)
