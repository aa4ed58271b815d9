from clickloom.functions.ids import (
    account_id,
    catalog_product_id,
    document_id,
    parse_session_number,
    routing_key,
    session_id,
)
from clickloom.functions.numbers import floor_div
from clickloom.functions.text import is_blank, java_trim
from clickloom.functions.times import (
    epoch_cell,
    iso_format,
    iso_parse,
    utc_day,
)

__all__ = [
    "account_id",
    "catalog_product_id",
    "document_id",
    "epoch_cell",
    "floor_div",
    "is_blank",
    "iso_format",
    "iso_parse",
    "java_trim",
    "parse_session_number",
    "routing_key",
    "session_id",
    "utc_day",
]
