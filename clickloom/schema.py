"""Event, catalog and document schemas, and the event-type vocabulary."""

from pyspark.sql import types as T

# The event-type vocabulary (exact, case-sensitive).
VIEW = "VIEW"
ADD_TO_CART = "ADD_TO_CART"
SEARCH = "SEARCH"
WISHLIST = "WISHLIST"
CLICK = "CLICK"
CHECKOUT = "CHECKOUT"
REMOVE_FROM_CART = "REMOVE_FROM_CART"
PURCHASE = "PURCHASE"

BROWSE_TYPES = (VIEW, CLICK, SEARCH)
CAPTURE_TYPES = (ADD_TO_CART, WISHLIST)
CLOSING_TYPES = (PURCHASE, REMOVE_FROM_CART)
ACTING_TYPES = CAPTURE_TYPES + (CHECKOUT,) + CLOSING_TYPES
FUNNEL_STAGES = (VIEW, ADD_TO_CART, CHECKOUT, PURCHASE)

# The nine event columns, in the order the JSON encoder writes them.
EVENT_COLUMNS = (
    "acc_id",
    "session_id",
    "event_time",
    "event_type",
    "product_id",
    "device_type",
    "time_on_page_minutes",
    "created_at",
    "updated_at",
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.IntegerType() if name == "time_on_page_minutes" else T.StringType(),
        )
        for name in EVENT_COLUMNS
    ]
)

# Columns a topic source delivers next to the payload.
ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("brand_id", T.StringType()),
        T.StructField("catalog_ord", T.LongType()),
    ]
)

# Alert kinds and the action each one asks for (fixed values).
INTENT_CAPTURED = "INTENT_CAPTURED"
CHECKOUT_FRICTION = "CHECKOUT_FRICTION"
CONVERSION_SUCCESS = "CONVERSION_SUCCESS"
CART_REMOVED = "CART_REMOVED"
DYNAMIC_PRICING = "DYNAMIC_PRICING"
FRICTION_ACTION = "20k Voucher/FreeShip"
PRICING_ACTION = "10% Extra Discount Coupon"

ALERT_KINDS = (
    INTENT_CAPTURED,
    CHECKOUT_FRICTION,
    CONVERSION_SUCCESS,
    CART_REMOVED,
    DYNAMIC_PRICING,
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_type", T.StringType()),
        T.StructField("acc_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("checkout_attempts", T.LongType()),
        T.StructField("start_session_id", T.StringType()),
        T.StructField("current_session_id", T.StringType()),
    ]
)
ALERT_COLUMNS = tuple(ALERT_SCHEMA.fieldNames())

# The columns each alert kind fills, after its account, product and event.
ALERT_FIELDS = {
    INTENT_CAPTURED: ("action", "session_id", "event_time"),
    CHECKOUT_FRICTION: ("action", "checkout_attempts"),
    CONVERSION_SUCCESS: ("checkout_attempts",),
    CART_REMOVED: (),
    DYNAMIC_PRICING: ("action", "start_session_id", "current_session_id"),
}


def alert_columns(kind: str) -> tuple[str, ...]:
    return ("alert_type", "acc_id", "product_id", "seq", *ALERT_FIELDS[kind])
