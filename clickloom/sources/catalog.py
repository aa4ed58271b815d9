"""Product catalog from delimited lines.

A line needs three comma-separated parts after its trailing empty parts are dropped; there
is no quoting, parts are trimmed, further parts are ignored and shorter lines are skipped.
The line order is kept in ``catalog_ord``: it decides the order of recommendations.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions import java_trim
from clickloom.schema import CATALOG_SCHEMA


def parse_catalog_lines(lines: DataFrame) -> DataFrame:
    """``line string, catalog_ord long`` to catalog rows."""
    body = F.regexp_replace("line", r",+\z", "")
    parts = lines.select(F.split(body, ",").alias("parts"), "catalog_ord")
    return parts.where(F.size("parts") >= 3).select(
        java_trim(F.col("parts")[0]).alias("product_id"),
        java_trim(F.col("parts")[1]).alias("category_id"),
        java_trim(F.col("parts")[2]).alias("brand_id"),
        F.col("catalog_ord").cast("long").alias("catalog_ord"),
    )


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Read one catalog file, header skipped; an absent file is an empty catalog.

    The ids of ``monotonically_increasing_id`` rise with the position in the file.
    """
    try:
        # A separator that no line holds keeps each line whole.
        lines = (
            spark.read.schema("line string")
            .option("header", True)
            .option("sep", "\u0001")
            .option("quote", "")
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CATALOG_SCHEMA)
    return parse_catalog_lines(
        lines.withColumn("catalog_ord", F.monotonically_increasing_id())
    )


def catalog_lookup(catalog: DataFrame) -> DataFrame:
    """One row per product id: the last line wins."""
    last = F.max(F.struct("catalog_ord", "category_id", "brand_id")).alias("last")
    return catalog.groupBy("product_id").agg(last).select("product_id", "last.*")
