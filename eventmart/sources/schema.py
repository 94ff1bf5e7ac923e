"""Record shapes and vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# Controlled vocabularies and bounds of the event contract.
EVENT_TYPES = ["product_viewed", "product_searched", "add_to_cart", "remove_from_cart", "checkout_started", "payment_failed", "order_placed", "order_cancelled", "refund_issued"]
CHANNELS = ["web", "mobile_app", "mobile_web", "marketplace", "store", "api"]
DEVICE_TYPES = ["desktop", "mobile", "tablet", "unknown"]
CURRENCIES = ["EUR", "USD", "GBP", "CHF", "CAD"]
PAYMENT_METHODS = ["card", "paypal", "bank_transfer", "wallet", "gift_card", "unknown"]
CUSTOMER_SEGMENTS = ["new", "returning", "loyal", "vip", "churn_risk", "unknown"]
MAX_QUANTITY, MAX_PRICE, MAX_TEXT = 100, 100_000, 1000
SCHEMA_VERSION = "3.0"

# Column names that partners use for each field, the first present and non-null one wins.
ALIASES = {
    "product_id": ["product_id", "sku", "id"],
    "sku": ["sku", "product_id"],
    "name": ["product_name", "name", "title"],
    "category": ["category", "product_category"],
    "brand": ["brand"],
    "price": ["price", "product_price", "unit_price"],
    "occurred_at": ["occurred_at", "event_time", "timestamp"],
    "event_type": ["event_type", "event", "action"],
    "session_id": ["session_id", "session"],
    "sequence": ["sequence", "event_sequence"],
    "device_type": ["device_type", "device"],
    "device_os": ["device_os", "os"],
    "customer_id": ["customer_id", "customer"],
    "segment": ["segment", "customer_segment"],
    "quantity": ["quantity", "qty"],
    "unit_price": ["unit_price", "price"],
    "discount_pct": ["discount_pct", "discount"],
    "payment_method": ["payment_method", "payment"],
    "campaign": ["campaign", "utm_campaign"],
    "utm_source": ["utm_source", "source"],
    "utm_medium": ["utm_medium", "medium"],
    "channel": ["channel"],
    "country": ["country"],
    "city": ["city"],
    "order_id": ["order_id"],
    "currency": ["currency"],
}

# Columns of the silver table, in order.
SILVER = [
    "idempotency_key", "event_id", "event_type", "occurred_ts", "occurred_at", "ingested_at", "channel", "device_type", "device_os", "session_id", "event_sequence",
    "product_id", "sku", "product_name", "category", "brand", "product_price", "customer_id", "customer_segment", "customer_country", "is_returning", "order_id",
    "quantity", "unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount", "signed_net_amount", "currency", "payment_method", "campaign",
    "utm_source", "utm_medium", "price_category", "is_revenue_event", "is_conversion", "day_of_week", "is_weekend", "partition_date", "partition_hour",
]


#: The nested event record.
EVENT = (
    T.StructType()
    .add("schema_version", "string").add("event_id", "string").add("idempotency_key", "string").add("ingested_at", "string").add("occurred_at", "string").add("channel", "string").add("event_type", "string")
    .add("session", T.StructType().add("session_id", "string").add("sequence", "integer"))
    .add("device", T.StructType().add("type", "string").add("os", "string").add("user_agent", "string"))
    .add("geo", T.StructType().add("country", "string").add("city", "string"))
    .add("product", T.StructType().add("product_id", "string").add("sku", "string").add("name", "string").add("category", "string").add("brand", "string").add("price", "double"))
    .add("customer", T.StructType().add("customer_id", "string").add("segment", "string").add("country", "string").add("is_returning", "boolean"))
    .add("order", T.StructType().add("order_id", "string").add("quantity", "integer").add("unit_price", "double").add("discount_pct", "double").add("gross_amount", "double").add("discount_amount", "double").add("net_amount", "double").add("amount", "double").add("currency", "string").add("payment_method", "string"))
    .add("marketing", T.StructType().add("campaign", "string").add("source", "string").add("medium", "string"))
    .add("_meta", T.StructType().add("processed_at", "string").add("source", "string").add("message_id", "string").add("source_object", "string"))
)
