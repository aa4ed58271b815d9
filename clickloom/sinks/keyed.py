"""Small tables of counts by key, kept up to date: every refresh writes only the keys that changed.

The table is partitioned by view and refresh. A refresh that is repeated replaces its own folder, so
a batch that runs again changes nothing; readers take every key's value from the newest refresh
that has it. Every ``FOLD`` refreshes the folders of a view are folded into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.plans import delete_folder

SCHEMA = "key string, events long, view string, refresh long"
FOLD = 64


def _stored(spark: SparkSession, path: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max(F.struct("refresh", "events"))["events"]
    return rows.groupBy("view", "key").agg(newest.alias("events"))


def _write(rows: DataFrame, path: str, number: int) -> None:
    (
        rows.select("view", "key", "events", F.lit(number).cast("long").alias("refresh"))
        .hint("rebalance", "view")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("view", "refresh")
        .parquet(path)
    )


def _fold(spark: SparkSession, path: str, number: int) -> None:
    """Fold every view's folders below ``number`` into one of that number, then delete them.

    A view that has the folder was folded by a run that broke off; only the deleting is left.
    """
    stored = _stored(spark, path).where(F.col("refresh") <= number)
    folders = stored.select("view", "refresh").distinct().collect()
    done = {row.view for row in folders if row.refresh == number}
    old = [row for row in folders if row.refresh < number]
    views = sorted({row.view for row in old} - done)
    if views:
        _write(_newest(stored.where(F.col("view").isin(views))), path, number)
    # One row per folder, at most ``fold`` a view.
    for row in old:
        delete_folder(spark, f"{path}/view={row.view}/refresh={row.refresh}")


def merge_counts(changed: DataFrame, path: str, refresh: int, fold: int = FOLD) -> None:
    """Write the changed rows ``view, key, events`` of one refresh; refreshes are numbered upwards.

    Folders of refreshes have even numbers, folded ones the odd number below the refresh that
    folded them, so that neither ever replaces the other.
    """
    if refresh and refresh % fold == 0:
        _fold(changed.sparkSession, path, 2 * refresh - 1)
    _write(changed, path, 2 * refresh)


def read_counts(spark: SparkSession, path: str, view: str) -> DataFrame:
    """The current ``key, events`` of one view; only its folders are read."""
    return _newest(_stored(spark, path).where(F.col("view") == view)).drop("view")
