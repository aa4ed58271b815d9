"""ISO-8601 text, UTC days and fixed-width time cells."""

from pyspark.sql import Column, functions as F

from clickloom.functions.numbers import floor_div
from clickloom.functions.text import _col

MICROS_PER_SECOND = 1_000_000
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def iso_parse(text: Column | str) -> Column:
    """Instant of an ISO-8601 text, honouring its offset; null when it does not parse.

    A date is required, and a text without an offset is UTC, whatever the session's zone.
    """
    text = F.trim(_col(text))
    zoned = text.rlike(r"(?i)[T ].*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?(:?\d{2})?)$")
    timed = text.rlike(r"(?i)\d[T ]\d")
    whole = F.when(zoned, text).when(timed, F.concat(text, F.lit("Z"))).otherwise(
        F.concat(text, F.lit("T00:00:00Z"))
    )
    return F.when(text.rlike(r"^[+-]?\d{4,}-\d{1,2}-\d{1,2}([T ]|$)"), F.try_to_timestamp(whole))


def iso_format(ts: Column | str) -> Column:
    """ISO-8601 text of an instant in UTC, in any session time zone."""
    return F.date_format(F.to_utc_timestamp(_col(ts), F.current_timezone()), ISO_PATTERN)


def epoch_cell(ts: Column | str, seconds: int) -> Column:
    """Number of the fixed-width time cell since the epoch, in any session time zone."""
    return floor_div(F.unix_micros(_col(ts)), seconds * MICROS_PER_SECOND)


def utc_day(ts: Column | str) -> Column:
    """The UTC calendar day of an instant as ``yyyy.MM.dd``, in any session time zone."""
    day = F.date_from_unix_date(epoch_cell(ts, 86_400).cast("int"))
    return F.date_format(day, "yyyy.MM.dd")
