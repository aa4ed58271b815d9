"""JSON payload to typed events, with undecodable records set aside.

Unknown keys are ignored and missing ones become null. Numbers, as they are written, and booleans
are accepted for text fields; ``time_on_page_minutes`` accepts integers, fractions (cut off) and quoted
integers. Anything else is a reject with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.schema import EVENT_COLUMNS

_CORRUPT = "_corrupt"
_MINUTES = "time_on_page_minutes"
_READ_SCHEMA = ", ".join(f"{name} string" for name in (*EVENT_COLUMNS, _CORRUPT))
_READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


# Fixed value: a number as JSON writes it, and what must follow one.
_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?=[\s,}\]])"
# Everything up to a number, texts as a whole; each match begins where the last has ended.
_BEFORE = r'\G((?:[^"0-9\-]++|"(?:[^"\\]++|\\.)*+")*+)'
_NUMBER_FOR_TEXT = rf'"(?!{_MINUTES}")[^"]*"\s*:\s*-?[0-9]'


def _quoted_numbers(value: Column) -> Column:
    """The record with its numbers in quotes, where a field other than the minutes has one.

    A parser that reads a number as text gives it a canonical form (``12.50`` becomes ``12.5``); in
    quotes it keeps its own. The rare records only; a number that is not one (``007``) stays.
    """
    quoted = F.regexp_replace(value, f"{_BEFORE}({_NUMBER})", '$1"$2"')
    return F.when(value.rlike(_NUMBER_FOR_TEXT), quoted).otherwise(value)


def _json_kind(field: str) -> Column:
    """Type name of a field in the raw JSON; only evaluated on the rare branches below."""
    raw = F.try_variant_get(F.try_parse_json("value"), f"$.{field}", "variant")
    return F.schema_of_variant(raw)


def _is_nested(field: str) -> Column:
    suspicious = F.col(field).startswith("{") | F.col(field).startswith("[")
    nested = F.coalesce(_json_kind(field).rlike(r"\A(OBJECT|ARRAY)"), F.lit(False))
    return F.when(suspicious, nested).otherwise(F.lit(False))


def _minutes(text: Column) -> Column:
    whole = F.trim(text)
    fraction = F.when(
        F.coalesce(_json_kind(_MINUTES) != "STRING", F.lit(True)), text.try_cast("double")
    )
    return F.when(whole.rlike(r"\A-?[0-9]{1,9}\z"), whole.try_cast("int")).otherwise(
        F.coalesce(whole.try_cast("int"), fraction.try_cast("int"))
    )


def decode_topic(records: DataFrame) -> DataFrame:
    """All records with the nine event columns and ``reject_reason`` (null when decoded)."""
    parsed = F.from_json(_quoted_numbers(F.col("value")), _READ_SCHEMA, _READ_OPTIONS)
    # As a generator the parse runs once per record: a filter on its output stays above it.
    fields = records.select("*", F.inline(F.array(parsed)))
    nested = F.lit(False)
    for name in EVENT_COLUMNS:
        if name != _MINUTES:
            nested = nested | _is_nested(name)
    text = F.col(_MINUTES)
    converted = fields.withColumn("_minutes", _minutes(text))
    no_minutes = text.isNull() | F.trim(text).isin("", "null")
    reason = (
        F.when(F.col("value").isNull(), "null_value")
        .when(F.col(_CORRUPT).isNotNull() | (F.trim("value") == ""), "malformed_json")
        .when(nested | (F.col("_minutes").isNull() & ~no_minutes), "wrong_type")
    )
    return (
        converted.withColumn("reject_reason", reason)
        .withColumn(_MINUTES, F.col("_minutes"))
        .drop("_minutes", _CORRUPT)
    )


def decode_events(records: DataFrame) -> DataFrame:
    """Decoded events with their envelope columns."""
    return decode_topic(records).where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine_events(records: DataFrame) -> DataFrame:
    """Records that did not decode: envelope, raw value and reason."""
    return (
        decode_topic(records).where(F.col("reject_reason").isNotNull()).drop(*EVENT_COLUMNS)
    )
