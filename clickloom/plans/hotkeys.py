"""Finding keys that hold too many rows, and choosing a join by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# A key with more rows than this is split; so at most rows / HOT_ROWS keys are hot.
HOT_ROWS = 5_000_000

# Width of the sequence range one task orders for a hot key. ``seq`` is unique within an
# account, so no task orders more than SPAN rows of it.
SPAN = 4_000_000

# A side is broadcast only when its measured content is at most this many bytes.
BROADCAST_BYTES = 128 * 1024 * 1024


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys holding more than ``hot_rows`` rows; counted with map-side combine."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > hot_rows).select(*keys)


def payload_bytes(df: DataFrame) -> int:
    """Content size of a (staged) table: text lengths plus fixed-width values."""

    def width(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(16)
        return F.lit(8)

    row = sum((width(f) for f in df.schema.fields), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast when it measures small.

    Beyond the limit it is returned as it is: the join then shuffles, and AQE splits the
    partitions of hot keys.
    """
    return F.broadcast(df) if payload_bytes(df) <= limit else df
