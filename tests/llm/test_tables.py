import time

import pytest
from pyspark.sql import functions as F

from clickloom.llm.tables import CLEANUP, stage_alone


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(k).getName() for k in range(blocks.size()) if blocks.apply(k).getName().startswith("shuffle_")}


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_shuffle_files_go_when_the_table_is_written(spark, before):
    if before:
        spark.conf.set(CLEANUP, before)
    try:
        seen = shuffle_files(spark)
        rows = spark.range(10_000).withColumn("k", F.xxhash64("id"))
        table = stage_alone(rows.groupBy("k").agg(F.max("id").alias("most")).join(rows.repartition("k"), "k"))
        until = time.time() + 20
        while shuffle_files(spark) - seen and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - seen
        assert table.count() == 10_000
        assert (spark.conf.get(CLEANUP) == before) if before else spark.conf.get(CLEANUP, None) in (None, "false")
    finally:
        spark.conf.unset(CLEANUP)
