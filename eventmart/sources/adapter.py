"""Partner export rows made from the shop tables: every cell is text, as in a CSV drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import iso


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks as the session has cores, if its files give fewer: what follows costs more than to deal the rows anew."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.toJavaRDD().getNumPartitions() < cores else df


def pick(index, *values: str):
    """The value at index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def flat_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each event, one more for each replay (every 20th event, an hour later, renamed) and for
    each second line of an order, with broken cells at fixed places."""
    e = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")).withColumn("ts", F.col("ts").cast("timestamp"))
    n = F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "view", F.when(n % 6 == 0, "product_searched").otherwise("product_viewed"))
        .when(F.col("event_type") == "click", F.when(n % 8 == 0, "remove_from_cart").otherwise("add_to_cart"))
        .when(F.col("event_type") == "signup", "checkout_started")
        .when(F.col("event_type") == "error", "payment_failed")
        .otherwise(F.when(n % 10 == 0, "order_cancelled").when(n % 10 == 1, "refund_issued").otherwise("order_placed"))
    )
    e = e.withColumns({"kind": kind, "k": F.get_json_object("props", "$.k").cast("int")})
    again = F.array_compact(F.array(F.lit("first"), F.when(n % 20 == 0, F.lit("replay")), F.when((F.col("kind") == "order_placed") & (n % 40 == 2), F.lit("line"))))
    e = e.withColumn("copy", F.explode(again))
    line = F.col("copy") == "line"
    e = e.withColumns({"at": F.when(line, F.col("ts") + F.expr("INTERVAL 2 SECONDS")).otherwise(F.col("ts")), "k": F.when(line, (F.col("k") + 1) % 100).otherwise(F.col("k"))})
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type")
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "n_name")
    e = e.join(part, "k", "left").join(people, "user_id", "left")
    user, day = F.col("user_id"), F.date_format("ts", "yyyyMMdd")
    order = F.col("kind").isin("checkout_started", "order_placed", "order_cancelled", "refund_issued")
    return e.select(
        F.when(n % 499 == 0, "not-a-date").otherwise(iso(F.col("at"))).alias("occurred_at"),
        F.col("kind").alias("event_type"),
        pick(user % 6, "web", "mobile_app", "mobile_web", "marketplace", "store", "api").alias("channel"),
        F.when(n % 101 != 0, F.concat(F.lit("sess-"), user, F.lit("-"), day)).alias("session_id"),
        (n % 5).cast("string").alias("sequence"),
        pick(user % 3, "desktop", "mobile", "tablet").alias("device_type"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("city"),
        F.when(n % 501 != 0, F.concat(F.lit("sku-"), F.col("k"))).alias("product_id"),
        F.when(F.col("copy") == "replay", F.concat("p_name", F.lit(" (renamed)"))).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(n % 97 != 0, F.col("value").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(n % 53 != 0, F.concat(F.lit("cust-"), user)).alias("customer_id"),
        F.lower("c_mktsegment").alias("segment"),
        F.when(order, F.concat(F.lit("ord-"), user, F.lit("-"), day)).alias("order_id"),
        F.when(n % 211 == 0, "500").otherwise((1 + n % 25).cast("string")).alias("quantity"),
        (n % 10 * 10).cast("string").alias("discount_pct"),
        F.when(n % 307 == 0, "XXX").otherwise("EUR").alias("currency"),
        pick(n % 3, "card", "paypal", "wallet").alias("payment_method"),
        F.concat(F.lit("camp-"), user % 5).alias("campaign"),
        F.lit("search").alias("utm_source"),
        F.lit("cpc").alias("utm_medium"),
        iso(F.when(F.col("copy") == "replay", F.col("at") + F.expr("INTERVAL 1 HOUR 5 SECONDS")).otherwise(F.col("at") + F.expr("INTERVAL 5 SECONDS"))).alias("ingested_at"),
    )
