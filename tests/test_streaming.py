import time

import pytest
from pyspark.sql import functions as F

from clickloom.operators import dashboards, intents, recommend
from clickloom.operators.sessions import sessionize_arrival
from clickloom.sinks import latest_by_id, read_day_counts, read_documents, typed_documents
from clickloom.sources import decode_events, stream_topic_files, tables
from clickloom.streaming import (
    read_funnel,
    start_documents,
    start_pipeline,
    start_table,
    stream_alerts,
    stream_sessions,
    use_rocksdb_state,
)
from tests.model import EVENT_FIELDS, messy_events, track

FILES = 3


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    use_rocksdb_state(spark)
    return tables.canonical_events(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def topic(spark, events, tmp_path_factory):
    """The topic as files of rising offsets, some records broken."""
    path = str(tmp_path_factory.mktemp("topic"))
    records = tables.with_malformed(tables.topic_records(events))
    for part in range(FILES):
        low, high = part * 334, (part + 1) * 334
        chosen = records.where((F.col("offset") >= low) & (F.col("offset") < high))
        chosen.repartition(1, F.col("key")).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def delivered(events):
    return events.where("seq % 53 <> 0")


def decoded(spark, topic, files=1):
    records = stream_topic_files(spark, topic, max_files_per_trigger=files)
    return decode_events(records).withColumn("seq", F.col("offset"))


def same(got, want):
    got = got.select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def run(query):
    query.awaitTermination()
    return query


def test_alerts_equal_the_batch_and_survive_a_restart(spark, topic, delivered, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = start_table(stream_alerts(decoded(spark, topic)), out, checkpoint, "0 seconds")
    while not query.recentProgress:
        time.sleep(0.05)
    query.stop()
    assert spark.read.parquet(out).count() < intents.pricing_alerts(delivered).count()
    run(start_table(stream_alerts(decoded(spark, topic)), out, checkpoint))
    same(spark.read.parquet(out), intents.pricing_alerts(delivered))


def test_state_is_carried_from_run_to_run(spark, tmp_path):
    """New files between runs of an ``availableNow`` query; messy input, model as judge."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = messy_events(5, size=300) + [
        (acc and acc.strip() and f"x{acc}", *rest) for acc, *rest in messy_events(6, size=300)]
    for part in range(3):
        piece = [r for r in rows if r[5] % 900 // 300 == part]
        spark.createDataFrame(piece, EVENT_FIELDS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT_FIELDS).parquet(source)
        run(start_table(stream_alerts(stream), out, str(tmp_path / "checkpoint")))
    want, _ = track(rows)
    got = sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=repr)
    assert got == want


def test_sessions_equal_the_batch(spark, topic, delivered, tmp_path):
    """Rows without an account or a time included."""
    time = F.when(F.col("seq") % 7 != 0, F.try_to_timestamp("event_time"))
    stream = decoded(spark, topic).withColumn("event_ts", time)
    run(start_table(stream_sessions(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    want = sessionize_arrival(delivered.withColumn("event_ts", time))
    assert want.where("session_no IS NULL").count() > 0
    same(spark.read.parquet(str(tmp_path / "out")),
         want.select("acc_id", "seq", "event_ts", "session_id", "time_on_page_minutes"))


def test_recommendations_equal_the_batch(spark, sf_dir, topic, delivered, tmp_path):
    catalog = tables.part_catalog(spark, sf_dir)
    lists = recommend.prepare_recommendations(catalog)
    stream = recommend.join_recommendations(decoded(spark, topic), lists)
    run(start_table(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    keys = ["acc_id", "product_id", "seq"]
    got = recommend.explode_ranked(spark.read.parquet(str(tmp_path / "out")), *keys)
    same(got, recommend.explode_ranked(recommend.recommend_events(delivered, catalog), *keys))


def test_pipeline_runs_every_job_on_its_own(spark, sf_dir, topic, events, delivered, tmp_path):
    """All five jobs over the same topic, started again later."""
    catalog, opened = tables.part_catalog(spark, sf_dir), []

    def open_topic(starting):
        opened.append(starting)
        return stream_topic_files(spark, topic)

    root = str(tmp_path)
    queries = start_pipeline(spark, open_topic, catalog, root)
    for query in queries.values():
        run(query)
    assert sorted(opened) == ["earliest"] * 4 + ["latest"]
    assert len({query.id for query in queries.values()}) == 5
    for query in start_pipeline(spark, open_topic, catalog, root).values():
        run(query)
    same(spark.read.parquet(f"{root}/alerts"), intents.pricing_alerts(delivered))
    lists = spark.read.parquet(f"{root}/recommendations")
    assert lists.count() == recommend.recommend_events(delivered, catalog).count()
    documents = read_documents(spark, f"{root}/documents")
    assert documents.where("kafka_offset <> seq OR kafka_topic IS NULL").count() == 0
    want = latest_by_id(typed_documents(delivered))
    same(documents.select(want.columns), want)
    same(read_day_counts(spark, f"{root}/days"), dashboards.daily_index_counts(typed_documents(delivered)))
    same(read_funnel(spark, f"{root}/dashboards"), dashboards.funnel(delivered))
    rejects = spark.read.parquet(f"{root}/rejects")
    assert rejects.count() == events.where("seq % 53 = 0").count()
    assert {r.reject_reason for r in rejects.collect()} == {"malformed_json"}


def test_dashboard_refresh(spark, topic, delivered, tmp_path):
    stream = decoded(spark, topic).withColumn("event_ts", F.try_to_timestamp("event_time"))
    query = (
        dashboards.ingestion_velocity(stream)
        .writeStream.format("memory").queryName("velocity").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run(query)
    same(spark.table("velocity"), dashboards.ingestion_velocity(delivered))


def test_a_new_checkpoint_is_a_new_writer(spark, topic, delivered, tmp_path):
    """Both queries number their batches from 0 over one table; nothing is lost."""
    path = str(tmp_path / "documents")
    for part in (0, 1):
        docs = typed_documents(decoded(spark, topic).where(F.col("seq") % 2 == part))
        run(start_documents(docs, path, str(tmp_path / f"cp{part}")))
    want = latest_by_id(typed_documents(delivered))
    same(read_documents(spark, path).select(want.columns), want)
