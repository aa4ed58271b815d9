"""Reading, staging and joining shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.plans import stage

# A side is broadcast only when the files it was written to are at most this large, and it
# has at most this many rows; beyond either, the join shuffles and AQE splits hot partitions.
SMALL_BYTES = 8 * 1024 * 1024
SMALL_ROWS = 1_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage_alone(df: DataFrame) -> DataFrame:
    """``stage``, and the shuffle files that it took go as soon as it is written, not when the
    driver happens to collect its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        # What is done with shuffle files is settled where a frame is made.
        return stage(df.select("*"))
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def staged_bytes(df: DataFrame) -> int:
    """Size of the files behind a staged table, as the planner knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, most_bytes: int = SMALL_BYTES, most_rows: int = SMALL_ROWS) -> bool:
    """Whether a staged table is within both bounds; the rows are only counted when its files
    are small."""
    return staged_bytes(df) <= most_bytes and df.count() <= most_rows


def beside(df: DataFrame) -> DataFrame:
    """A staged table as the right side of a join: broadcast if it is small."""
    return F.broadcast(df) if small(df) else df


__all__ = ["SMALL_BYTES", "SMALL_ROWS", "beside", "read", "small", "stage", "stage_alone", "staged_bytes"]
