"""Text predicates and trimming with Java string semantics."""

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Null, empty, or nothing but characters Java counts as whitespace."""
    c = _col(c)
    return c.isNull() | c.rlike(r"\A\p{javaWhitespace}*\z")


def java_trim(c: Column | str) -> Column:
    """Strip code points up to U+0020 from both ends."""
    return F.regexp_replace(_col(c), r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")
