"""Reporting views and analyses over silver and gold. as_of stands for today and defaults to the last day of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import money


def day() -> Column:
    return F.to_date("partition_date")


def last_day(df: DataFrame, as_of: str | None, column: Column | None = None) -> DataFrame:
    """df with as_of in a column of one value."""
    days = day() if column is None else column
    if as_of is not None:
        return df.withColumn("as_of", F.to_date(F.lit(as_of)))
    return df.crossJoin(F.broadcast(df.agg(F.max(days).alias("as_of"))))


def cents(c: str, condition: Column | None = None) -> Column:
    value = money(F.col(c))
    return F.sum(value if condition is None else F.when(condition, value))


def revenue_daily(silver: DataFrame) -> DataFrame:
    placed, back = F.col("event_type") == "order_placed", F.col("event_type").isin("order_cancelled", "refund_issued")
    return silver.filter("partition_date <> 'unknown'").groupBy(day().alias("day"), "channel").agg(
        F.count_if(placed).alias("orders"), F.countDistinct("customer_id").alias("customers"), cents("signed_net_amount").cast("double").alias("net_revenue"),
        cents("signed_net_amount", placed).cast("double").alias("gross_revenue"), (-cents("signed_net_amount", back)).cast("double").alias("reversals"),
    )


def funnel(funnel_daily: DataFrame) -> DataFrame:
    rest = [c for c in funnel_daily.columns if c not in ("partition_date", "customers", "revenue")]
    return funnel_daily.filter("partition_date <> 'unknown'").select(day().alias("day"), *rest)


def customer_360(rfm: DataFrame, sessions: DataFrame) -> DataFrame:
    s = sessions.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(F.max("session_end").alias("last_session_at"), F.round(F.avg(money(F.col("revenue"))), 2).cast("double").alias("revenue_per_session"))
    return rfm.withColumnRenamed("monetary", "lifetime_revenue").select("customer_id", "country", "declared_segment", "rfm_segment", "recency_days", "orders", "lifetime_revenue", "avg_order_value", "refund_rate_pct", "is_buyer", "sessions").join(s, "customer_id", "left")


def product_performance(product_daily: DataFrame) -> DataFrame:
    p = product_daily.filter("partition_date <> 'unknown'").groupBy("product_id").agg(
        *[F.max(c).alias(c) for c in ("product_name", "category", "brand")], F.round(F.avg(money(F.col("avg_price"))), 2).cast("double").alias("avg_price"),
        F.sum("views").alias("lifetime_views"), F.sum("cart_adds").alias("lifetime_cart_adds"), F.sum("units_sold").alias("lifetime_units_sold"), cents("revenue").cast("double").alias("lifetime_revenue"), F.countDistinct("partition_date").alias("active_days"),
    )
    views, units = F.col("lifetime_views").cast("decimal(18,0)"), F.col("lifetime_units_sold").cast("decimal(18,0)")
    return p.withColumn("view_to_unit_pct", F.when(views > 0, F.round(units * 100 / views, 2).cast("double")))


def anomalies_recent(anomalies: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    recent = last_day(anomalies.filter("partition_date <> 'unknown'"), as_of).filter(day() >= F.date_sub("as_of", days))
    v = recent.groupBy(day().alias("day"), "severity", "reasons").agg(F.count("*").alias("events"), cents("net_amount").cast("double").alias("amount_at_risk"), F.countDistinct("customer_id").alias("customers"))
    return v.orderBy((F.col("severity") == "high").desc(), F.desc_nulls_last("amount_at_risk"))


def revenue_month(revenue: DataFrame, as_of: str | None = None) -> DataFrame:
    this = last_day(revenue, as_of, F.col("day")).filter(F.col("day") >= F.trunc("as_of", "month"))
    return this.select("day", "channel", "orders", "net_revenue", "reversals").orderBy(F.desc("day"), F.desc("net_revenue"))


def funnel_leaks(funnel_daily: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    lost = [F.sum(F.col(a) - F.col(b)).alias(n) for a, b, n in (("viewed", "carted", "lost_view_to_cart"), ("carted", "checked_out", "lost_cart_to_checkout"), ("checked_out", "ordered", "lost_checkout_to_order"))]
    recent = last_day(funnel_daily, as_of).filter(day() >= F.date_sub("as_of", days))
    return recent.groupBy("channel").agg(*lost).orderBy(F.greatest("lost_view_to_cart", "lost_cart_to_checkout", "lost_checkout_to_order").desc())


def segment_value(rfm: DataFrame) -> DataFrame:
    return rfm.filter("is_buyer").groupBy("rfm_segment").agg(F.count("*").alias("customers"), cents("monetary").cast("double").alias("revenue_at_stake"), F.round(F.avg(F.col("recency_days").cast("decimal(10,0)")), 1).cast("double").alias("avg_days_since_last_order")).orderBy(F.desc("revenue_at_stake"))


def viewed_not_bought(performance: DataFrame, min_views: int = 100, top: int = 20) -> DataFrame:
    return performance.filter(F.col("lifetime_views") >= min_views).orderBy(F.asc_nulls_last("view_to_unit_pct"), F.desc("lifetime_views"), "product_id").limit(top).select("product_name", "category", "lifetime_views", "lifetime_units_sold", "lifetime_revenue", "view_to_unit_pct")


def reconcile_orders(orders: DataFrame, silver: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Each order counts once, however many lines it has."""
    facts = silver.filter("event_type = 'order_placed' AND order_id IS NOT NULL").select(F.col("order_id").alias("fact_id")).distinct()
    recent = last_day(orders, as_of).filter(day() >= F.date_sub("as_of", days))
    both = recent.join(facts, F.col("order_id") == F.col("fact_id"), "left")
    return both.groupBy(day().alias("day")).agg(F.countDistinct("order_id").alias("orders_in_gold"), F.count("fact_id").alias("orders_in_facts"), cents("realized_revenue").cast("double").alias("revenue_in_gold")).orderBy(F.desc("day"))


def session_quality(sessions: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    recent = last_day(sessions, as_of).filter(day() >= F.date_sub("as_of", days))
    mean = lambda c, digits, kind="decimal(18,0)": F.round(F.avg(F.col(c).cast(kind)), digits).cast("double")
    return recent.groupBy("converted").agg(F.count("*").alias("sessions"), mean("duration_seconds", 1).alias("avg_seconds"), mean("events", 1).alias("avg_events"), mean("distinct_products", 1).alias("avg_products_seen"), mean("revenue", 2, "decimal(18,2)").alias("avg_revenue"))


def anomaly_triage(anomalies: DataFrame, as_of: str | None = None, days: int = 7, top: int = 25) -> DataFrame:
    recent = last_day(anomalies_recent(anomalies, as_of), as_of, F.col("day")).filter(F.col("day") >= F.date_sub("as_of", days))
    reasons = F.concat_ws(",", "reasons")
    return recent.orderBy(F.desc_nulls_last("amount_at_risk"), F.desc("day"), "severity", reasons).limit(top).select("day", "severity", "reasons", "events", "amount_at_risk")
