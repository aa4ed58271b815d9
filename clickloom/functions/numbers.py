"""Exact integer arithmetic."""

from pyspark.sql import Column, functions as F

from clickloom.functions.text import _col


def floor_div(value: Column | str, width: int) -> Column:
    """Number of the fixed-width range a long falls into, negatives included."""
    value, width = _col(value), F.lit(width)
    return F.call_function("div", value - F.pmod(value, width), width)
