"""The clean, typed and deduplicated event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.columns import event_time, money
from eventmart.sources.schema import MAX_QUANTITY, MAX_TEXT, SILVER


def flatten(df: DataFrame) -> DataFrame:
    """Event records as flat columns, with defaults for what may be missing."""
    default = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    return df.select(
        # fixed values: names, order and defaults of the silver columns
        "idempotency_key", "event_id", default("event_type", "unknown").alias("event_type"), event_time(F.col("occurred_at")).alias("occurred_ts"), "occurred_at", "ingested_at",
        default("channel", "unknown").alias("channel"), default("device.type", "unknown").alias("device_type"), F.col("device.os").alias("device_os"),
        F.col("session.session_id").alias("session_id"), F.col("session.sequence").alias("event_sequence"),
        F.col("product.product_id").alias("product_id"), F.col("product.sku").alias("sku"), F.trim("product.name").alias("product_name"), F.col("product.category").alias("category"), F.col("product.brand").alias("brand"),
        F.coalesce("order.unit_price", "product.price").alias("product_price"),
        F.col("customer.customer_id").alias("customer_id"), default("customer.segment", "unknown").alias("customer_segment"), F.coalesce("customer.country", "geo.country").alias("customer_country"), default("customer.is_returning", False).alias("is_returning"),
        F.col("order.order_id").alias("order_id"), default("order.quantity", 1).alias("quantity"), F.col("order.unit_price").alias("unit_price"), default("order.discount_pct", 0.0).alias("discount_pct"),
        F.col("order.gross_amount").alias("gross_amount"), default("order.discount_amount", 0.0).alias("discount_amount"), F.coalesce("order.net_amount", "order.amount").alias("net_amount"),
        default("order.currency", "EUR").alias("currency"), default("order.payment_method", "unknown").alias("payment_method"),
        F.col("marketing.campaign").alias("campaign"), F.col("marketing.source").alias("utm_source"), F.col("marketing.medium").alias("utm_medium"),
    )


def usable() -> Column:
    """Flat events with a product and a time."""
    return (F.length(F.trim("product_id")) > 0) & F.col("occurred_ts").isNotNull()


def clean(df: DataFrame) -> DataFrame:
    """Drops rows without product or time; resets quantities and discounts out of range; cuts long names."""
    return df.filter(usable()).withColumns({
        "quantity": F.when(F.col("quantity").between(1, MAX_QUANTITY), F.col("quantity")).otherwise(1),
        "discount_pct": F.when(F.col("discount_pct").between(0, 100), F.col("discount_pct")).otherwise(0.0),
        "product_name": F.substring("product_name", 1, MAX_TEXT),
    })


def derive(df: DataFrame) -> DataFrame:
    """Price category, revenue flags and sign, calendar and partition columns."""
    price, kind, net = F.col("product_price"), F.col("event_type"), F.coalesce("net_amount", F.lit(0.0))
    signed = F.when(kind == "order_placed", net).when(kind.isin("order_cancelled", "refund_issued"), 0.0 - net).otherwise(0.0)
    return df.withColumns({
        "price_category": F.when(price.isNull(), "unknown").when(price < 50, "budget").when(price < 200, "mid").otherwise("premium"),
        "is_revenue_event": kind == "order_placed",
        "is_conversion": kind == "order_placed",
        "signed_net_amount": signed,
        "day_of_week": F.date_format("occurred_ts", "EEEE"),
        "is_weekend": F.dayofweek("occurred_ts").isin(1, 7),
        "partition_date": F.coalesce(F.date_format("occurred_ts", "yyyy-MM-dd"), F.lit("unknown")),
        "partition_hour": F.coalesce(F.date_format("occurred_ts", "HH"), F.lit("unknown")),
    })


# Fields that tell events without a key apart.
NATURAL_KEY = ["event_type", "occurred_at", "session_id", "product_id", "customer_id", "order_id"]


def event_key() -> Column:
    """The key of a flat event, or its natural fields where it has none."""
    return F.coalesce("idempotency_key", F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in NATURAL_KEY]))


def deal_key() -> Column:
    """What flat events are dealt by: their session; those without one by what else tells them apart."""
    return F.coalesce("session_id", "idempotency_key", F.xxhash64("occurred_at", "product_id", "customer_id").cast("string"))


def copies(flat: DataFrame) -> DataFrame:
    """One row: raw, clean, days (of clean events) and torn, the keys whose copies differ in what they are dealt by or in their day.

    Keys are met by hashes, so what is shuffled is small; two keys of one hash count as torn.
    """
    day, ok = F.to_date("occurred_ts"), F.coalesce(usable(), F.lit(False))
    marks = flat.select(ok.alias("ok"), F.when(ok, F.xxhash64(event_key())).alias("key"), F.when(ok, day).alias("day"), F.xxhash64(event_key(), deal_key(), day).alias("a"), F.hash(deal_key()).alias("b"))
    by_key = marks.groupBy("ok", "key").agg(F.count("*").alias("n"), *[f(c).alias(f"{name}_{c}") for c in "ab" for name, f in (("min", F.min), ("max", F.max))], F.min("day").alias("day"))
    torn = F.col("ok") & ((F.col("min_a") != F.col("max_a")) | (F.col("min_b") != F.col("max_b")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_key.agg(total("n").alias("raw"), total(F.when(F.col("ok"), F.col("n"))).alias("clean"), F.collect_set(F.date_format("day", "yyyy-MM-dd")).alias("days"), F.count_if(torn).alias("torn"))


def deduplicate(df: DataFrame, *together: str) -> DataFrame:
    """The latest arrival of each event; rows without a key are told apart by their natural fields. together: columns that all copies of an event agree in."""
    latest = Window.partitionBy(*together, event_key()).orderBy(F.desc_nulls_last("ingested_at"), F.xxhash64(*[c for c in df.columns if c not in together]))
    return df.withColumn("_arrival", F.row_number().over(latest)).filter("_arrival = 1").drop("_arrival")


def to_silver(bronze: DataFrame, process_date: str | None = None, lookback_days: int = 0) -> DataFrame:
    """Silver of a bronze table; with process_date, of that day and the `lookback_days` before it.

    The window is applied to bronze: equal events have equal times, so it commutes with the deduplication.
    """
    return flatten(window(bronze, process_date, lookback_days)).transform(clean).transform(deduplicate).transform(derive).select(*SILVER)


def dealt_silver(bronze: DataFrame, tasks: int) -> DataFrame:
    """Silver of a bronze table without torn keys (see `copies`), dealt over so many tasks by `deal_key`: one exchange serves the deduplication and the layout."""
    dealt = clean(flatten(bronze)).withColumn("_deal", deal_key()).repartition(tasks, "_deal")
    return deduplicate(dealt, "_deal").transform(derive).select(*SILVER)


def window(df: DataFrame, process_date: str | None, lookback_days: int = 0, day=None) -> DataFrame:
    """Rows of a processing window by day column (by default the day of occurred_at)."""
    if process_date is None:
        return df
    day = F.to_date(event_time(F.col("occurred_at"))) if day is None else day
    end = F.to_date(F.lit(process_date))
    return df.filter((day <= end) & (day >= F.date_sub(end, lookback_days)))


def signed_total():
    return F.coalesce(F.sum(money(F.col("signed_net_amount"))), F.lit(0)).cast("double")
