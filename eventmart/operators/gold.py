"""Six tables derived from silver events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.columns import earliest, money, named, share
from eventmart.operators.ranking import ntiles
from eventmart.operators.silver import signed_total
from eventmart.plans.scratch import materialized


# Columns of silver that orders are made of, and those of customers.
ORDER_COLUMNS = [
    "idempotency_key", "event_type", "occurred_ts", "order_id", "customer_id", "session_id", "channel", "device_type", "customer_country", "currency", "payment_method", "campaign", "product_id", "quantity",
    "gross_amount", "discount_amount", "net_amount",
]
CUSTOMER_COLUMNS = [*ORDER_COLUMNS, "customer_segment"]


def kinds(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def sessions(silver: DataFrame) -> DataFrame:
    """One row for each session: attributes at their first value, stage counts, revenue, duration, outcome."""
    s = silver.filter("session_id IS NOT NULL").groupBy("session_id").agg(
        *[earliest(c).alias(n) for c, n in (("customer_id", "customer_id"), ("channel", "channel"), ("device_type", "device_type"), ("customer_country", "country"), ("campaign", "campaign"), ("utm_source", "utm_source"))],
        F.min("occurred_ts").alias("session_start"),
        F.max("occurred_ts").alias("session_end"),
        F.count("*").alias("events"),
        F.countDistinct("product_id").alias("distinct_products"),
        *[F.count_if(kinds(k)).alias(n) for k, n in (("product_viewed", "views"), ("add_to_cart", "cart_adds"), ("remove_from_cart", "cart_removals"), ("checkout_started", "checkouts"), ("payment_failed", "payment_failures"), ("order_placed", "orders"))],
        signed_total().alias("revenue"),
    )
    return s.withColumns({
        "duration_seconds": F.unix_timestamp("session_end") - F.unix_timestamp("session_start"),
        "converted": F.col("orders") > 0,
        "bounced": (F.col("events") == 1) & (F.col("views") == 1),
        "partition_date": F.date_format("session_start", "yyyy-MM-dd"),
    })


def funnel_daily(silver: DataFrame) -> DataFrame:
    """By day and channel, of events with a session: sessions that reached each stage, customers, revenue and rates.

    The events of a session are reduced to one row for each of its customers first; what is counted distinct after
    that is small.
    """
    stages = {"viewed": "product_viewed", "carted": "add_to_cart", "checked_out": "checkout_started", "ordered": "order_placed"}
    by_session = silver.filter("session_id IS NOT NULL").groupBy("partition_date", "channel", "session_id", "customer_id").agg(*[F.bool_or(kinds(k)).alias(n) for n, k in stages.items()], F.sum(money(F.col("signed_net_amount"))).alias("revenue"))
    f = by_session.groupBy("partition_date", "channel").agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct("customer_id").alias("customers"), *[F.countDistinct(F.when(F.col(n), F.col("session_id"))).alias(n) for n in stages], F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue")
    )
    rate = lambda a, b: share(F.col(a), F.col(b))
    return f.select(
        "partition_date", "channel", "sessions", "customers", *stages, F.col("revenue").cast("double").alias("revenue"),
        rate("carted", "viewed").alias("view_to_cart_pct"), rate("checked_out", "carted").alias("cart_to_checkout_pct"), rate("ordered", "checked_out").alias("checkout_to_order_pct"), rate("ordered", "sessions").alias("overall_conversion_pct"),
        F.when(F.col("sessions") > 0, F.round(F.col("revenue") / F.col("sessions"), 2).cast("double")).otherwise(0.0).alias("revenue_per_session"),
    )


def orders(silver: DataFrame) -> DataFrame:
    """One row for each placed order: attributes, basket, reversals, status and realised revenue, in one pass over its lines."""
    placed = "event_type = 'order_placed'"
    of_placed = lambda call: F.expr(f"{call} FILTER (WHERE {placed})")
    cents = lambda c, kind: F.expr(f"CAST(coalesce(sum(CAST({c} AS DECIMAL(18,2))) FILTER (WHERE {kind}), 0) AS DOUBLE)")
    both = silver.filter(F.col("order_id").isNotNull() & kinds("order_placed", "order_cancelled", "refund_issued")).groupBy("order_id").agg(
        *[earliest(c, placed).alias(n) for c, n in (("customer_id", "customer_id"), ("session_id", "session_id"), ("channel", "channel"), ("device_type", "device_type"), ("customer_country", "country"), ("currency", "currency"), ("payment_method", "payment_method"), ("campaign", "campaign"))],
        of_placed("min(occurred_ts)").alias("ordered_at"),
        of_placed("count(DISTINCT product_id)").alias("line_items"),
        of_placed("sum(quantity)").alias("units"),
        *[cents(c, placed).alias(c) for c in ("gross_amount", "discount_amount", "net_amount")],
        F.bool_or(kinds("order_cancelled")).alias("cancelled"),
        F.bool_or(kinds("refund_issued")).alias("refunded"),
        cents("net_amount", f"NOT {placed}").alias("reversed_amount"),
    ).filter("ordered_at IS NOT NULL")
    return both.withColumns({
        "status": F.when(F.col("cancelled"), "cancelled").when(F.col("refunded"), "refunded").otherwise("completed"),
        "realized_revenue": (money(F.col("net_amount")) - money(F.col("reversed_amount"))).cast("double"),
        "avg_item_value": F.when(F.col("units") > 0, F.round(money(F.col("net_amount")) / F.col("units"), 2).cast("double")).otherwise(0.0),
        "partition_date": F.date_format("ordered_at", "yyyy-MM-dd"),
    })


def customer_rfm(silver: DataFrame, order_table: DataFrame | None = None) -> DataFrame:
    """One row for each customer: engagement, and for buyers recency, frequency and monetary quintiles with a segment."""
    placed = (orders(silver) if order_table is None else order_table).filter("customer_id IS NOT NULL AND status <> 'cancelled'")
    engaged = silver.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(F.countDistinct("session_id").alias("sessions"), F.count("*").alias("events"), earliest("customer_segment").alias("declared_segment"), earliest("customer_country").alias("country"))
    buyers = placed.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum(money(F.col("realized_revenue"))).alias("m"), F.min("ordered_at").alias("first_order_at"), F.max("ordered_at").alias("last_order_at"), F.sum("units").alias("units"), F.count_if("refunded").alias("refunded_orders")
    )
    as_of = silver.agg(F.max("occurred_ts").alias("as_of"))
    buyers = buyers.crossJoin(F.broadcast(as_of)).select(
        "customer_id", "orders", F.col("m").cast("double").alias("monetary"), "first_order_at", "last_order_at", "units", F.round(F.col("m") / F.col("orders"), 2).cast("double").alias("avg_order_value"), "refunded_orders",
        F.datediff("as_of", "last_order_at").alias("recency_days"), share(F.col("refunded_orders"), F.col("orders")).alias("refund_rate_pct"),
    )
    buyers = materialized(buyers, "buyers")
    buyers = ntiles(buyers, 5, {"r_score": -F.col("recency_days"), "f_score": F.col("orders"), "m_score": F.col("monetary")}, "customer_id")
    # fixed values: score bounds of the segments
    score = F.col("r_score") + F.col("f_score") + F.col("m_score")
    segment = F.when(score >= 13, "champion").when(score >= 10, "loyal").when(score >= 7, "potential").when(F.col("r_score") <= 2, "at_risk").otherwise("hibernating")
    scored = buyers.withColumns({"rfm_score": score, "rfm_segment": segment})
    return engaged.join(scored, "customer_id", "left").withColumn("is_buyer", F.col("rfm_score").isNotNull())


def product_daily(silver: DataFrame, top_n: int | None = None) -> DataFrame:
    """By day and product: attributes, views, sales and the revenue rank of the day; only the first top_n if given."""
    placed = kinds("order_placed")
    p = silver.filter("product_id IS NOT NULL").groupBy("partition_date", "product_id").agg(
        *[earliest(c).alias(c) for c in ("product_name", "category", "brand", "price_category")],
        F.round(F.avg(money(F.col("product_price"))), 2).cast("double").alias("avg_price"),
        F.count_if(kinds("product_viewed")).alias("views"),
        F.count_if(kinds("add_to_cart")).alias("cart_adds"),
        F.count_if(placed).alias("orders"),
        F.coalesce(F.sum(F.when(placed, F.col("quantity"))), F.lit(0)).alias("units_sold"),
        signed_total().alias("revenue"),
        F.countDistinct("customer_id").alias("customers"),
    )
    rank = F.row_number().over(Window.partitionBy("partition_date").orderBy(F.desc("revenue"), "product_id"))
    ranked = p.withColumn("view_to_order_pct", share(F.col("orders"), F.col("views"))).withColumn("revenue_rank", rank)
    return ranked if top_n is None else ranked.filter(F.col("revenue_rank") <= top_n)


def anomalies(silver: DataFrame, threshold: float = 5000.0, by_session: bool = False) -> DataFrame:
    """Events with at least one suspicious trait; two or more make the severity high.

    by_session: silver is stored by session, so that its sessions need no exchange; it is then read once more for events without one.
    """
    gap = F.unix_timestamp("occurred_ts") - F.unix_timestamp("_before")
    reasons = named(
        high_amount=F.col("net_amount") > threshold,
        bulk_quantity=F.col("quantity") >= 20,
        extreme_discount=F.col("discount_pct") >= 80,
        negative_amount=F.col("net_amount") < 0,
        anonymous_purchase=F.col("customer_id").isNull(),
        rapid_fire=kinds("order_placed") & (gap < 5),
        missing_price=F.col("product_price").isNull(),
    )
    time = ["occurred_ts", "event_sequence", "idempotency_key"]
    none = F.lit(None).cast("timestamp")  # events without a session have none before them
    if by_session:
        before = F.lag("occurred_ts").over(Window.partitionBy("session_id").orderBy(*time))
        timed = silver.filter("session_id IS NOT NULL").withColumn("_before", before).union(silver.filter("session_id IS NULL").withColumn("_before", none))
    else:
        before = F.lag("occurred_ts").over(Window.partitionBy("session_id", F.when(F.col("session_id").isNull(), F.col("idempotency_key"))).orderBy(*time))
        timed = silver.withColumn("_before", F.when(F.col("session_id").isNotNull(), before).otherwise(none))
    marked = timed.withColumn("reasons", reasons).filter(F.size("reasons") > 0)
    return marked.select(
        "partition_date", "occurred_ts", "event_type", "idempotency_key", "session_id", "customer_id", "product_id", "order_id", "quantity", "discount_pct", "net_amount", "channel", "reasons",
        F.when(F.size("reasons") >= 2, "high").otherwise("low").alias("severity"),
    )
