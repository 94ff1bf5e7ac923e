"""Shapes of the warehouse tables: columns, types and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the warehouse tables in order, by type, and their keys.
TABLES = {
    "fact_events": """idempotency_key string, event_id string, event_type string, occurred_ts timestamp, occurred_at string, ingested_at string, channel string, device_type string, device_os string, session_id string,
        event_sequence int, product_id string, sku string, product_name string, category string, brand string, product_price decimal(12,2), customer_id string, customer_segment string, customer_country string,
        is_returning boolean, order_id string, quantity int, unit_price decimal(12,2), discount_pct decimal(5,2), gross_amount decimal(12,2), discount_amount decimal(12,2), net_amount decimal(12,2),
        signed_net_amount decimal(12,2), currency char(3), payment_method string, campaign string, utm_source string, utm_medium string, price_category string, is_revenue_event boolean, is_conversion boolean,
        day_of_week string, is_weekend boolean, partition_date string, partition_hour string""",
    "fact_sessions": """session_id string, customer_id string, channel string, device_type string, country string, campaign string, utm_source string, session_start timestamp, session_end timestamp, events bigint,
        distinct_products bigint, views bigint, cart_adds bigint, cart_removals bigint, checkouts bigint, payment_failures bigint, orders bigint, revenue decimal(14,2), duration_seconds bigint,
        converted boolean, bounced boolean, partition_date string""",
    "fact_orders": """order_id string, customer_id string, session_id string, channel string, device_type string, country string, currency char(3), payment_method string, campaign string, ordered_at timestamp,
        line_items bigint, units bigint, gross_amount decimal(14,2), discount_amount decimal(14,2), net_amount decimal(14,2), cancelled boolean, refunded boolean, reversed_amount decimal(14,2), status string,
        realized_revenue decimal(14,2), avg_item_value decimal(14,2), partition_date string""",
    "fact_anomalies": """partition_date string, occurred_ts timestamp, event_type string, idempotency_key string, session_id string, customer_id string, product_id string, order_id string, quantity int,
        discount_pct decimal(5,2), net_amount decimal(12,2), channel string, reasons array<string>, severity string""",
    "dim_customer_rfm": """customer_id string, sessions bigint, events bigint, declared_segment string, country string, orders bigint, monetary decimal(14,2), first_order_at timestamp, last_order_at timestamp,
        units bigint, avg_order_value decimal(14,2), refunded_orders bigint, recency_days int, refund_rate_pct decimal(6,2), r_score int, f_score int, m_score int, rfm_score int, rfm_segment string, is_buyer boolean""",
    "agg_funnel_daily": """partition_date string, channel string, sessions bigint, customers bigint, viewed bigint, carted bigint, checked_out bigint, ordered bigint, revenue decimal(14,2), view_to_cart_pct decimal(6,2),
        cart_to_checkout_pct decimal(6,2), checkout_to_order_pct decimal(6,2), overall_conversion_pct decimal(6,2), revenue_per_session decimal(12,2)""",
    "agg_product_daily": """partition_date string, product_id string, product_name string, category string, brand string, price_category string, avg_price decimal(12,2), views bigint, cart_adds bigint, orders bigint,
        units_sold bigint, revenue decimal(14,2), customers bigint, view_to_order_pct decimal(6,2), revenue_rank int""",
}
KEYS = {
    "fact_events": ["idempotency_key"],
    "fact_sessions": ["session_id"],
    "fact_orders": ["order_id"],
    "fact_anomalies": [],
    "dim_customer_rfm": ["customer_id"],
    "agg_funnel_daily": ["partition_date", "channel"],
    "agg_product_daily": ["partition_date", "product_id"],
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def shaped(df: DataFrame, table: str) -> DataFrame:
    """The columns of a warehouse table in its order and types; a missing one is an error, as is a value that its type cannot hold."""
    if missing := [f.name for f in schema(table) if f.name not in df.columns]:
        raise ValueError(f"{table} lacks {missing}")
    return df.select(*[F.col(f.name).cast("string" if f.dataType.typeName() == "char" else f.dataType).alias(f.name) for f in schema(table)])
