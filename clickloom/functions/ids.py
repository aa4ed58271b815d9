"""Identifier formats, parsing and keys."""

from pyspark.sql import Column, functions as F

from clickloom.functions.text import _col


def session_id(number: Column | str) -> Column:
    return F.format_string("SS%08d", _col(number))


def account_id(number: Column | str) -> Column:
    return F.format_string("ACC%08d", _col(number))


def catalog_product_id(number: Column | str) -> Column:
    return F.format_string("PR%03d", _col(number))


def parse_session_number(session: Column | str) -> Column:
    """All digits of the id as an int; 0 when there are none or they overflow."""
    digits = F.regexp_replace(_col(session), r"\D+", "")
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def routing_key(acc_id: Column | str = "acc_id") -> Column:
    return _col(acc_id)


def document_id() -> Column:
    """account_session_time from the raw texts; an absent field keeps its placeholder."""

    def part(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(f"%{{{name}}}"))

    return F.concat(
        part("acc_id"), F.lit("_"), part("session_id"), F.lit("_"), part("event_time")
    )
