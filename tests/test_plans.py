"""Physical plans: what is shuffled, pruned, split and never paired up."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.check_sql import ORACLE_SQL
from clickloom.operators import dashboards, intents, recommend
from clickloom.operators.pricing import session_summary
from clickloom.operators.sessions import sessionize
from clickloom.sources import tables
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    tables.canonical_events(spark, SMALL).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def settings(spark):
    changed = []

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.append((key, spark.conf.get(key, None)))
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)

    yield change
    for key, value in reversed(changed):
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_no_query_pairs_rows_or_runs_python(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_small_lists_leave_the_events_unshuffled(spark, stored):
    text = plan(recommend.recommend_events(stored, tables.part_catalog(spark, SMALL)))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert re.search(r"PushedFilters: \[[^]]*In\(event_type", text)


def test_summary_reads_three_columns(stored):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(session_summary(stored)))
    assert schemas and all(schema.count(":") == 3 for schema in schemas)


def test_alerts_order_rows_in_one_shuffle(stored, settings):
    settings(adaptive__enabled="false")
    text = plan(intents.pricing_alerts(stored))
    assert text.count("Exchange hashpartitioning(acc_id") == 1


def test_only_ended_intents_are_shuffled_to_their_sessions(stored, settings, monkeypatch):
    """A large summary is met behind the windows: acting rows are exchanged once, by pair."""
    settings(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(intents, "SUMMARY_BYTES", -1)
    for operator in (intents.dynamic_pricing, intents.open_intents):
        lines = plan(operator(stored)).splitlines()
        exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(acc_id" in line]
        by_pair = [i for i in exchanges if "product_id" in lines[i].split("hashpartitioning")[1]]
        windows = [i for i, line in enumerate(lines) if "Window " in line]
        assert len(exchanges) == 3 and len(by_pair) == 1
        # Printed from the top: the session's exchange, the windows, the exchange by pair.
        assert exchanges[0] < min(windows) and max(windows) < by_pair[0]


def test_small_inputs_count_hot_keys_without_writing(stored, monkeypatch):
    """Branch alerts of an input without hot pairs stage nothing."""
    monkeypatch.setattr(intents, "stage", None)
    assert intents.branch_alerts(stored, "CHECKOUT_FRICTION").count() >= 0


def test_top_products_never_sorts_everything(stored):
    text = plan(dashboards.top_products(stored))
    assert "TakeOrderedAndProject" in text and "partial_count" in text


def test_hot_account_is_split_in_the_session_join(spark, settings):
    """Two thirds of the rows in one cell of one account."""
    start = datetime(2024, 1, 1)
    rows = [("HOT", start, i) for i in range(20000)] + [
        (f"A{i % 50}", start + timedelta(minutes=i), 20000 + i) for i in range(10000)]
    df = spark.createDataFrame(rows, "acc_id string, event_ts timestamp, seq long")
    df = df.withColumn("payload", F.sha2(F.col("seq").cast("string"), 512)).repartition(8)
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    result = sessionize(df)
    assert result.where("session_no IS NULL").count() == 0
    result.collect()
    assert "skew=true" in plan(result)


def test_unordered_sessions_take_the_search(spark, sf_dir):
    """Accounts step back here, so the plan holds the node search and the discounts it finds."""
    text = plan(entry.queries()["pricing_alerts_unordered"](spark, sf_dir))
    ordered = plan(entry.queries()["pricing_alerts"](spark, sf_dir))
    assert text.count("Exchange") > ordered.count("Exchange") and "Union" in text
