"""Dashboards and daily counts that are kept up to date, against the same questions over all events."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import dashboards
from clickloom.sinks import (
    append_documents,
    compact_documents,
    count_days,
    latest_by_id,
    merge_counts,
    newest_documents,
    read_documents,
    read_counts,
    read_day_counts,
    typed_documents,
)
from clickloom.sources import tables
from clickloom.streaming import (
    read_device_share,
    read_funnel,
    first_deliveries,
    read_top_products,
    read_velocity,
    start_dashboards,
    start_documents,
    use_rocksdb_state,
)

PARTS = 3


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    use_rocksdb_state(spark)
    return tables.canonical_events(spark, sf_dir).cache()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def part_of(events, k):
    return events.where(F.col("seq") % PARTS == k)


def same_views(spark, path, seen):
    assert rows_of(read_velocity(spark, path)) == rows_of(dashboards.ingestion_velocity(seen))
    assert rows_of(read_funnel(spark, path)) == rows_of(dashboards.funnel(seen))
    assert rows_of(read_top_products(spark, path)) == rows_of(dashboards.top_products(seen))
    assert rows_of(read_device_share(spark, path)) == rows_of(dashboards.device_share(seen))


def test_dashboards_after_every_batch(spark, events, tmp_path):
    """One file more per run; the third run folds what the others wrote."""
    source, path = str(tmp_path / "in"), str(tmp_path / "counts")
    seen = events.limit(0)
    for k in range(PARTS):
        part_of(events, k).coalesce(1).write.mode("append").parquet(source)
        seen = seen.unionByName(part_of(events, k))
        stream = spark.readStream.schema(events.schema).parquet(source)
        start_dashboards(stream, path, str(tmp_path / "cp"), fold=2).awaitTermination()
        same_views(spark, path, seen)
    refreshes = [r.refresh for r in spark.read.parquet(path).where("view = 'funnel'").select("refresh").distinct().collect()]
    assert sorted(refreshes) == [3, 4]


def test_nothing_yet(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_velocity(spark, path).count() == read_top_products(spark, path).count() == 0
    assert [r.events for r in read_funnel(spark, path).collect()] == [0] * 4


def test_a_refresh_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "counts")

    def rows(*pairs):
        return spark.createDataFrame([("v", k, n) for k, n in pairs], "view string, key string, events long")

    merge_counts(rows(("a", 1), ("b", 1)), path, 0)
    merge_counts(rows(("a", 2)), path, 1)
    merge_counts(rows(("a", 3)), path, 1)
    assert dict(rows_of(read_counts(spark, path, "v"))) == {"a": 3, "b": 1}
    merge_counts(rows(("c", 7)), path, 2, fold=2)
    merge_counts(rows(("c", 7)), path, 2, fold=2)
    assert dict(rows_of(read_counts(spark, path, "v"))) == {"a": 3, "b": 1, "c": 7}
    assert read_counts(spark, path, "w").count() == 0
    # A fold that wrote its folder and broke off before it deleted the others.
    merge_counts(rows(("a", 9)), path, 3)
    merge_counts(rows(("b", 5)), path, 4)
    spark.read.parquet(path).where("refresh = 4").withColumn("refresh", F.lit(1)).write.mode("append").partitionBy("view", "refresh").parquet(path)
    merge_counts(rows(("d", 1)), path, 6, fold=2)
    merge_counts(rows(("d", 1)), path, 6, fold=2)
    assert dict(rows_of(read_counts(spark, path, "v"))) == {"a": 9, "b": 5, "c": 7, "d": 1}


def test_daily_counts_after_deliveries_replays_and_compaction(spark, events, tmp_path):
    path, counts = str(tmp_path / "documents"), str(tmp_path / "days")
    docs = typed_documents(events)
    low, high = docs.where("seq % 5 < 3"), docs.where("seq % 5 > 1")
    seen = []
    for refresh, (rows, batch) in enumerate([(low, 0), (high, 1), (low, 0), (high, 1), (docs, 2)]):
        delivery = append_documents(rows, path, batch, "w")
        count_days(spark, path, delivery, counts, refresh)
        seen.append(rows)
        union = seen[0]
        for other in seen[1:]:
            union = union.unionByName(other)
        assert rows_of(read_day_counts(spark, counts)) == rows_of(dashboards.daily_index_counts(union))
        if refresh == 2:
            assert compact_documents(spark, path) > 0
    # Only the ids of the delivery's days are read.
    one = docs.where(F.col("index_date") == docs.agg(F.min("index_date")).first()[0])
    day = one.select("index_date").distinct()
    count_days(spark, path, append_documents(one, path, 3, "w"), counts, 9)
    changed = spark.read.parquet(counts).where("refresh = 18").select("key").collect()
    assert [r.key for r in changed] == [r.index_date for r in day.collect()]


def test_documents_compact_themselves(spark, events, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "documents")
    for k in range(PARTS):
        part_of(events, k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_documents(
        typed_documents(stream), path, str(tmp_path / "cp"), compact_every=PARTS, counts=str(tmp_path / "days")
    ).awaitTermination()
    stored = spark.read.parquet(path).select("index_date", "delivery").distinct()
    assert stored.groupBy("index_date").count().where("count > 1").count() == 0
    want = dashboards.daily_index_counts(typed_documents(events))
    assert rows_of(read_day_counts(spark, str(tmp_path / "days"))) == rows_of(want)


def test_newest_documents_from_few_days(spark, events, tmp_path):
    """The newest day holds replays of one document only, so the next ones are read as well."""
    path = str(tmp_path / "documents")
    docs = typed_documents(events)
    append_documents(docs, path, 0, "w")
    late = docs.limit(1).withColumn("index_date", F.lit("9998.01.01")).withColumn("event_ts", F.lit("9998-01-01").cast("timestamp"))
    for batch in (1, 2, 3):
        append_documents(late.withColumn("seq", F.lit(10**6 + batch).cast("long")), path, batch, "w")
    for limit in (1, 2, 50, 10_000):
        got = newest_documents(spark, path, limit)
        want = dashboards.latest_documents(read_documents(spark, path), limit)
        assert [(r.doc_id, r.seq) for r in got.collect()] == [(r.doc_id, r.seq) for r in want.collect()]
    files = {f.split("index_date=")[1].split("/")[0] for f in newest_documents(spark, path, 1).inputFiles()}
    plan = newest_documents(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    assert files and "9998.01.01" in plan and "PartitionFilters" in plan
    # Documents without a day are last.
    append_documents(docs.limit(1).withColumn("index_date", F.lit(None).cast("string")).withColumn("event_ts", F.lit(None).cast("timestamp")).withColumn("doc_id", F.lit("none")), path, 9, "w")
    everything = newest_documents(spark, path, 10_000).collect()
    assert everything[-1].doc_id == "none" and len(everything) == read_documents(spark, path).count()


def test_first_deliveries(spark, events, tmp_path):
    """Replays within the bound go; the state forgets ids behind it."""
    source = str(tmp_path / "in")
    docs = typed_documents(events).select("index_date", "doc_id", "event_ts", "seq").orderBy("event_ts", "seq").cache()
    bounds = docs.selectExpr("percentile(unix_micros(event_ts), array(0.33, 0.66, 1.0))").first()[0]
    low, kept = -1, []
    for high in bounds:
        part = docs.where((F.unix_micros("event_ts") > low) & (F.unix_micros("event_ts") <= high))
        part.unionByName(part.where("seq % 3 = 0")).coalesce(1).write.mode("append").parquet(source)
        low = high
        stream = spark.readStream.schema(docs.schema).parquet(source)
        query = first_deliveries(stream, "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = rows_of(spark.read.parquet(str(tmp_path / "out")).select("index_date", "doc_id"))
    assert got == rows_of(latest_by_id(docs).select("index_date", "doc_id"))
    assert max(kept) < len(got)


def test_session_totals_of_a_stream(spark, events, tmp_path):
    """Closed sessions of a stream are those of the table; exactly the gap is no gap."""
    from clickloom.operators.sessions import session_totals

    want = {tuple(r) for r in session_totals(events).collect()}
    source = str(tmp_path / "in")
    end = events.agg(F.max("event_ts")).first()[0]
    middle = events.selectExpr("percentile(unix_micros(event_ts), 0.5)").first()[0]
    for part in (F.unix_micros("event_ts") <= middle, F.unix_micros("event_ts") > middle):
        events.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source).withWatermark("event_ts", "1 minute")
        query = session_totals(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
        query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got <= want and {r[2] for r in want - got} <= {r[2] for r in want if (end - r[2]).total_seconds() <= 16 * 60}

    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    steps = [timedelta(0), timedelta(minutes=15), timedelta(minutes=30, microseconds=1)]
    rows = spark.createDataFrame([("A", start + s, "P") for s in steps] + [("", start, "P"), ("A", None, "P")], "acc_id string, event_ts timestamp, product_id string")
    assert sorted(r.events for r in session_totals(rows).collect()) == [1, 2]
